"""Factorised relations expand to every related pair, and stay short."""

from itertools import combinations

import pytest

from ledgerlens.checks import inputs
from ledgerlens.plans import relation_classes as rc

SF_DIR = "/root/testdata/sf0.001"


def plain_pairs(contacts):
    held = {}
    for entity, rel, val in contacts:
        held.setdefault(entity, set()).add((rel, val))
    out = {}
    for a, b in combinations(sorted(held), 2):
        common = sorted(held[a] & held[b])
        if common:
            rels = sorted({r for r, _ in common})
            out[a, b] = (
                ", ".join(rels),
                ", ".join("{" + r + ": " + ", ".join(v for x, v in common if x == r) + "}" for r in rels),
            )
    return out


def expanded(classes):
    rows = rc.expanded(classes).collect()
    got = {(r["a"], r["b"]): (r["relationship"], r["relationship_detail"]) for r in rows}
    assert len(got) == len(rows)
    return got


def contacts_of(spark, rows):
    return spark.createDataFrame(rows, "entity string, rel string, val string")


@pytest.mark.parametrize("listed", [1, 4, 40])
def test_expansion_is_every_related_pair(spark, listed):
    contacts = inputs.contacts(spark, SF_DIR)
    want = plain_pairs({(r["entity"], r["rel"], r["val"]) for r in contacts.collect()})
    classes = rc.relation_classes(contacts, listed)
    assert expanded(classes) == want
    assert sum(r["n_links"] for r in classes.links.collect()) == len(want)


def test_copies_and_hubs(spark):
    rows = [(f"c{i:03}", "phone", "1") for i in range(60)] + [(f"c{i:03}", "mail", "m") for i in range(20)]
    rows += [(f"d{i:03}", "phone", "1") for i in range(30)] + [(f"d{i:03}", "mail", f"d{i // 2}") for i in range(30)]
    rows += [(f"e{i:03}", "phone", "2") for i in range(25)] + [(f"e{i:03}", "id", str(i)) for i in range(25)]
    rows += [("e000", "phone", "1"), ("alone", "phone", "9"), ("c000", "phone", "1")]
    classes = rc.relation_classes(contacts_of(spark, rows), listed=5)
    want = plain_pairs(set(rows))
    assert expanded(classes) == want
    links = classes.links.collect()
    assert sum(r["n_links"] for r in links) == len(want) and len(links) < 60
    members = {r["entity"]: (r["node"], r["hub"]) for r in classes.members.collect()}
    assert members["c019"][0] == "c000" and members["c020"][0] == "c020" and members["alone"] == ("alone", None)
    assert members["e001"][1] == "e001" and members["e000"][1] == "e000"


def test_rows_grow_with_the_entities(spark):
    def links(n):
        rows = [(f"s{i:04}", "phone", "switchboard") for i in range(n)] + [(f"s{i:04}", "mail", f"m{i // 3}") for i in range(n)]
        return rc.relation_classes(contacts_of(spark, rows), listed=10).links.count()

    assert links(400) <= 2 * links(200) + 2


def test_no_contacts(spark):
    classes = rc.relation_classes(contacts_of(spark, []))
    assert classes.members.count() == 0 and classes.links.count() == 0
