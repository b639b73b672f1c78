"""Contact values out of free text, as array expressions.

Each function takes a text column and gives the distinct normalized values in order
of appearance; null text gives an empty array. Character classes are Unicode-aware.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import union_of_arrays

# Patterns and limits of the three kinds of contact value.
NON_DIGITS = r"(?U)\D+"
SEPARATORS = r"(?U)[\s,;|/]+"
EMAIL = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"
NOT_DOCUMENT = r"[^A-Z0-9]"
COUNTRY_CODE = "84"
COUNTRY_CODE_MIN_DIGITS = 11
PHONE_DIGITS = (9, 12)

# How each kind of shared value is named in reports.
SAME_PHONE = "Trùng SĐT"
SAME_EMAIL = "Trùng email"
SAME_DOCUMENT = "Trùng Số giấy tờ người đại diện"


def _distinct(values: Column) -> Column:
    return F.coalesce(F.array_distinct(values), F.array().cast("array<string>"))


def phones(text: Column) -> Column:
    """Digit runs as national numbers: country code becomes 0, leading zeros collapse."""

    def national(run: Column) -> Column:
        abroad = run.startswith(COUNTRY_CODE) & (F.length(run) >= COUNTRY_CODE_MIN_DIGITS)
        local = F.when(abroad, F.concat(F.lit("0"), F.substring(run, 3, 1 << 30))).otherwise(run)
        return F.regexp_replace(local, "^0+", "0")

    numbers = F.transform(F.split(text.cast("string"), NON_DIGITS), national)
    return _distinct(F.filter(numbers, lambda n: F.length(n).between(*PHONE_DIGITS)))


def emails(text: Column) -> Column:
    """Well-formed addresses in lower case."""
    return _distinct(F.filter(F.split(F.lower(text.cast("string")), SEPARATORS), lambda p: p.rlike(EMAIL)))


def documents(text: Column) -> Column:
    """Identity-document numbers: upper case letters and digits only."""
    parts = F.split(F.upper(text.cast("string")), SEPARATORS)
    return _distinct(F.filter(F.transform(parts, lambda p: F.regexp_replace(p, NOT_DOCUMENT, "")), lambda p: p != ""))


def contact_values(
    cards: DataFrame,
    entity: str,
    phone_cols: Sequence[str] = (),
    email_cols: Sequence[str] = (),
    document_cols: Sequence[str] = (),
) -> DataFrame:
    """One row per distinct ``(entity, rel, val)``. Absent columns count as empty.

    A card gives many times its size in contacts, so the few files of cards are dealt to
    many tasks, by all they hold, before contacts are taken from them.
    """
    present = set(cards.columns)

    def merged(parse, names: Sequence[str]) -> Column:
        return union_of_arrays(*[parse(F.col(n)) for n in names if n in present])

    def tagged(values: Column, rel: str) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(rel).alias("rel"), v.alias("val")))

    everything = F.concat(
        tagged(merged(phones, phone_cols), SAME_PHONE),
        tagged(merged(emails, email_cols), SAME_EMAIL),
        tagged(merged(documents, document_cols), SAME_DOCUMENT),
    )
    used = [entity, *dict.fromkeys(c for c in (*phone_cols, *email_cols, *document_cols) if c in present and c != entity)]
    dealt = cards.filter(F.col(entity).isNotNull()).select(*used).repartition(*used)
    return (
        dealt.select(F.trim(F.col(entity).cast("string")).alias("entity"), F.explode(everything).alias("c"))
        .select("entity", "c.rel", "c.val")
        .distinct()
    )
