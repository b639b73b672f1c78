import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import contacts
from ledgerlens.plans import related


def values(spark, parse, text):
    return spark.createDataFrame([(text,)], "t string").select(parse(F.col("t")).alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, []),
        ("", []),
        ("84912345678", ["0912345678"]),
        ("+84912345678; 0912345678", ["0912345678"]),
        ("+84 912345678", ["912345678"]),
        ("8491234567", ["8491234567"]),
        ("000912345678", ["0912345678"]),
        ("12345678", []),
        ("1234567890123", []),
        ("0222333444 / 0111222333", ["0222333444", "0111222333"]),
    ],
)
def test_phones(spark, text, expected):
    assert values(spark, contacts.phones, text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, []),
        ("A@X.com, a@x.com", ["a@x.com"]),
        ("b@y.org|bad@|@z.vn/c.d+e@sub.z.vn", ["b@y.org", "c.d+e@sub.z.vn"]),
        ("a@x.c", []),
    ],
)
def test_emails(spark, text, expected):
    assert values(spark, contacts.emails, text) == expected


@pytest.mark.parametrize(
    ("text", "expected"), [(None, []), ("ab-12.3; AB123", ["AB123"]), ("--, x y", ["X", "Y"])]
)
def test_documents(spark, text, expected):
    assert values(spark, contacts.documents, text) == expected


CARDS = [
    (" 1 ", "0912345678", "a@x.com", "ID1"),
    ("2", "+84912345678", None, "id1"),
    ("3", "0912345678/0988777666", "A@X.com", None),
    ("4", "0988777666", None, ""),
    ("5", None, None, None),
]


def cards(spark):
    return spark.createDataFrame(CARDS, "entity string, phone string, email string, doc string")


def every_pair(spark):
    names = sorted({c[0].strip() for c in CARDS if c[0]})
    return spark.createDataFrame([(a, b) for a in names for b in names if a < b], "a string, b string")


def found(spark):
    held = contacts.contact_values(cards(spark), "entity", ["phone", "absent"], ["email"], ["doc"])
    rows = related.related_pairs(every_pair(spark), held).collect()
    return {(r.a, r.b): (r.relationship, r.relationship_detail) for r in rows}


ALL_PAIRS = {
    ("1", "2"): (
        "Trùng SĐT, Trùng Số giấy tờ người đại diện",
        "{Trùng SĐT: 0912345678}, {Trùng Số giấy tờ người đại diện: ID1}",
    ),
    ("1", "3"): ("Trùng SĐT, Trùng email", "{Trùng SĐT: 0912345678}, {Trùng email: a@x.com}"),
    ("2", "3"): ("Trùng SĐT", "{Trùng SĐT: 0912345678}"),
    ("3", "4"): ("Trùng SĐT", "{Trùng SĐT: 0988777666}"),
}


def test_related_pairs(spark):
    assert found(spark) == ALL_PAIRS


def test_every_member_of_every_group_is_listed_once(spark):
    held = contacts.contact_values(cards(spark), "entity", ["phone"], ["email"], ["doc"])
    members = [(r.val, r.entity, r.holders) for r in related.shared_members(held).collect()]
    assert len(members) == len(set(members))
    assert {m for m in members if m[0] == "0912345678"} == {("0912345678", e, 3) for e in "123"}
    listed = {(a, b) for v, a, _ in members for w, b, _ in members if v == w and a < b}
    assert listed == set(ALL_PAIRS)
    assert {r.val for r in related.shared_members(held, 3).collect()} == {"0912345678"}
    asked = spark.createDataFrame([("2", "3"), ("1", "4")], "a string, b string")
    assert [(r.a, r.b, r.val) for r in related.evidence(asked, held).collect()] == [("2", "3", "0912345678")]


def test_every_pair_of_every_group_is_listed_once_per_value(spark, monkeypatch):
    held = [(f"e{i}", "r", "switchboard") for i in range(40)] + [("e3", "r", "2"), ("e1", "r", "2"), ("e9", "r", "1"), ("e3", "q", "2"), ("e7", "q", "2")]
    contacts = spark.createDataFrame(held, "entity string, rel string, val string")
    want = {(rel, val, *sorted((a, b))) for a, rel, val in held for b, r, v in held if (rel, val) == (r, v) and a != b}
    seen = []
    known = related.known_heavy
    monkeypatch.setattr(related, "known_heavy", lambda *args, **more: seen.append(known(*args, **more)) or seen[-1])
    for block in (100, 7):
        rows = related.shared_pairs(contacts, block, 50).collect()
        assert len(rows) == len(want) == 782 and {(r.rel, r.val, r.a, r.b) for r in rows} == want
        assert {r.holders for r in rows if r.val == "switchboard"} == {40}
    parts = [None if h is None else [(r.val, r["_parts"]) for r in h.collect()] for h in seen[1::2]]
    assert parts == [None, [("switchboard", 6)]]


def test_published_report_round_trip(spark):
    held = contacts.contact_values(cards(spark), "entity", ["phone"], ["email"], ["doc"])
    report = related.published(related.related_pairs(every_pair(spark), held))
    assert report.columns == list(related.REPORT_COLUMNS.values())
    swapped = report.select(
        F.col("`Mã số thuế bên liên quan`").alias("x"), F.col("`Mã số thuế đơn vị`").alias("y"), *report.columns[2:]
    )
    swapped = swapped.toDF(*report.columns).unionByName(report)
    back = {(r.a, r.b): r.relationship for r in related.from_published(swapped).collect()}
    assert back == {k: v[0] for k, v in ALL_PAIRS.items()}


def test_revenue_links(spark):
    rows = [
        ("2026-02-01 10:00:00", " 1", "2", 100.0),
        ("2026-02-03 10:00:00", "2", "1", 50.0),
        ("2026-01-03 10:00:00", "1", "4", None),
        ("2025-02-28 00:00:00", "1", "4", 7.0),
        ("2025-02-27 23:59:59", "1", "4", 1000.0),
        ("2026-02-01 10:00:00", "1", "1", 9.0),
        ("2026-02-01 10:00:00", None, "1", 9.0),
        ("nonsense", "1", "2", 9.0),
    ]
    invoices = spark.createDataFrame(rows, "record_ts string, seller string, buyer string, with_vat double")
    traded = related.trades(invoices, now="2026-02-28 23:59:59")
    held = contacts.contact_values(cards(spark), "entity", ["phone"], ["email"], ["doc"])
    links = related.revenue_links(traded, related.trading_relations(traded, held))
    pairs = {(r.issuer, r.buyer): (r.revenue_12m, r.invoice_count_12m, r.is_related) for r in links.pairs.collect()}
    assert pairs == {("1", "2"): (100.0, 1, True), ("1", "4"): (7.0, 2, False), ("2", "1"): (50.0, 1, True)}
    one = links.sellers.first()
    assert (one.revenue_to_related_12m, one.revenue_to_unrelated_12m) == (100.0, 7.0)
    assert (one.n_counterparties, one.n_related_counterparties) == (2, 1)
    assert {(r.issuer, r.buyer, str(r.month_start)) for r in links.months.collect()} == {
        ("1", "2", "2026-02-01"),
        ("1", "4", "2026-01-01"),
        ("1", "4", "2025-02-01"),
        ("2", "1", "2026-02-01"),
    }
    same = related.revenue_links(traded, related.from_published(related.published(related.related_pairs(every_pair(spark), held))))
    assert sorted(same.pairs.collect()) == sorted(links.pairs.collect())
    own = related.trades(invoices, now="2026-02-28 23:59:59", include_self=True)
    assert own.filter("issuer = buyer").count() == 1
