"""What each buyer bought per period and how: adjusted sales, counts and modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.aggregates import count_if, distinct_counts
from ledgerlens.functions.scalars import clean_key, safe_divide
from ledgerlens.operators import windows
from ledgerlens.operators.joins import adjusted_amount
from ledgerlens.sources.invoices import is_issued

PERIOD_BUYER = ("partition_month", "buyer")

ATTRIBUTES = ("transport", "payment", "buyer_address")

# This report reads the adjustment status, with its own codes.
STATUS_MONEY = 2
STATUS_REPLACED = 3


def attribute_modes(invoices: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """Distinct values and the most frequent value of each attribute.

    All attributes are counted together as (attribute, value) rows. The mode is the first
    row of a ranking that Spark cuts before the shuffle. Equal counts go to the smaller value.
    """
    entry = [F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes]
    counted = (
        invoices.select(*PERIOD_BUYER, "invoice_id", F.explode(F.array(*entry)).alias("e"))
        .filter(F.col("e.value").isNotNull())
        .select(*PERIOD_BUYER, "invoice_id", "e.attribute", "e.value")
        .groupBy(*PERIOD_BUYER, "attribute", "value")
        .agg(F.count_distinct("invoice_id").alias("n"))
    )
    of_attribute = {name: F.col("attribute") == name for name in attributes}
    counts = counted.groupBy(*PERIOD_BUYER).agg(*[count_if(mine).alias(f"count_{n}") for n, mine in of_attribute.items()])
    best = windows.top_rows(counted, [*PERIOD_BUYER, "attribute"], "n", "value", 1)
    # One entry per attribute, laid side by side from a map: a pivot of texts would sort.
    modes = best.groupBy(*PERIOD_BUYER).agg(F.map_from_entries(F.collect_list(F.struct("attribute", "value"))).alias("mode"))
    named = modes.select(*PERIOD_BUYER, *[F.col("mode")[n].alias(f"most_freq_{n}") for n in attributes])
    return counts.join(named, list(PERIOD_BUYER), "left").select(
        *PERIOD_BUYER, *[c for n in attributes for c in (f"count_{n}", f"most_freq_{n}")]
    )


def buyer_ratios(invoices: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Sales, counts and the ratios between them; ``invoices`` needs ``adjusted_sale``.

    ``counted`` holds the same invoices, where they can be read without their amounts.
    """
    sums = invoices.groupBy(*PERIOD_BUYER).agg(
        F.sum("adjusted_sale").alias("total_sales"), F.sum("settlement_discount").alias("total_discount")
    )
    counts = distinct_counts(
        invoices if counted is None else counted,
        PERIOD_BUYER,
        {
            "number_of_buyer": F.col("buyer_name"),
            "number_of_invoice": F.col("invoice_id"),
            "number_of_sold_item": F.col("items"),
        },
    )
    totals = sums.join(counts, list(PERIOD_BUYER), "left").na.fill(0, subset=counts.columns[2:])
    totals = totals.select(*PERIOD_BUYER, "total_sales", *counts.columns[2:], "total_discount")
    pairs = {
        "total_sales_per_number_buyer": ("total_sales", "number_of_buyer"),
        "total_sales_per_number_invoice": ("total_sales", "number_of_invoice"),
        "total_sales_per_number_sold_item": ("total_sales", "number_of_sold_item"),
        "number_sold_item_per_number_invoice": ("number_of_sold_item", "number_of_invoice"),
        "number_sold_item_per_number_buyer": ("number_of_sold_item", "number_of_buyer"),
        "discount_per_sales": ("total_discount", "total_sales"),
    }
    return totals.withColumns({n: safe_divide(F.col(a), F.col(b)) for n, (a, b) in pairs.items()})


def buyer_profile(invoices: DataFrame, amount: str = "double") -> DataFrame:
    """Ratios and modes of every issued invoice, per period and buyer.

    Counts and modes need no adjusted amount, so only the sums read the looked-up rows.
    """
    issued = _known(invoices.filter(is_issued()))
    adjusted = adjusted_amount(
        invoices, invoices, amount, code_col="adjust_status", money_code=STATUS_MONEY, replacement_code=STATUS_REPLACED
    )
    ratios = buyer_ratios(_known(adjusted.filter(is_issued())), issued)
    return ratios.join(attribute_modes(issued), list(PERIOD_BUYER), "left")


def _known(invoices: DataFrame) -> DataFrame:
    keyed = invoices.withColumn("buyer", clean_key(F.col("buyer")))
    return keyed.filter(F.col("buyer").isNotNull() & F.col("partition_month").isNotNull())
