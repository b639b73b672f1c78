"""From logical invoice rows to typed analysis rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates, scalars
from ledgerlens.operators.joins import adjusted_amount

# Fixed values of the invoice source.
ISSUED = 1
APPROVED_PATTERN = "%_CODE_APPROVED%"  # the underscore matches any one character
COUNTED_ADJUST_TYPES = ("1", "3", "7", "9")


@dataclass(frozen=True)
class InvoicePolicy:
    """Which invoices count, when they count, and what they are worth.

    ``sale``          ``precomputed`` reads the sale column; ``adjusted`` looks up the
                      original of correcting invoices
    ``approved_only`` daily rows need an approval code, a signature and a counted type
    ``event_time``    ``signed``, or ``issued`` with the record time as fallback
    ``filter_pairs``  apply the status filter at buyer grain as well
    ``issued_originals`` an original must itself be issued to be looked up
    ``night_flag``    the feature table carries the night-sale verdict
    ``amount``        type amounts are cast to
    """

    sale: str = "precomputed"
    approved_only: bool = True
    event_time: str = "signed"
    filter_pairs: bool = False
    issued_originals: bool = True
    night_flag: bool = False
    amount: str = "double"


# The three generations of rules, and the SQL reading of the first one.
CURRENT = InvoicePolicy()
SECOND = InvoicePolicy(approved_only=False, event_time="issued", filter_pairs=True, night_flag=True)
FIRST = InvoicePolicy(
    sale="adjusted", approved_only=False, event_time="issued", filter_pairs=True, night_flag=True
)
FIRST_SQL = InvoicePolicy(
    sale="adjusted",
    approved_only=False,
    event_time="issued",
    filter_pairs=True,
    issued_originals=False,
    night_flag=True,
)


def is_issued() -> Column:
    return scalars.to_int(F.col("status")) == ISSUED


def is_approved() -> Column:
    """Issued, signed, approved and of a type that counts."""
    return (
        is_issued()
        & F.col("signed_ts").isNotNull()
        & F.col("error_code").like(APPROVED_PATTERN)
        & F.col("adjust_type").cast("string").isin(*COUNTED_ADJUST_TYPES)
    )


def event_time(df: DataFrame, policy: InvoicePolicy) -> Column:
    if policy.event_time == "signed":
        return scalars.to_timestamp(df, "signed_ts")
    return F.coalesce(scalars.to_timestamp(df, "issue_ts"), scalars.to_timestamp(df, "record_ts"))


def month_slice(df: DataFrame, run_date: dt.date) -> DataFrame:
    """Rows of the month a run reports on, by the source's partition column."""
    return df.filter(F.col("partition_month") == dates.closed_month_key(run_date))


def window_slice(df: DataFrame, date_col: str, run_date: dt.date, months: int = 12) -> DataFrame:
    """Rows of the trailing window a run reports on."""
    last = dates.last_closed_day(run_date)
    return df.filter(dates.within(date_col, dates.month_start(last, months - 1), last))


def analysis_rows(invoices: DataFrame, policy: InvoicePolicy = CURRENT) -> DataFrame:
    """Typed invoice rows with a usable seller and date.

    Nothing else is filtered: ``counts`` marks rows the daily grain includes, so one
    scan serves both the filtered daily measures and the unfiltered monthly ones.
    """

    def amount(name: str) -> Column:
        return F.col(name).try_cast(policy.amount)

    if policy.sale == "adjusted":
        only = is_issued() if policy.issued_originals else None
        invoices = adjusted_amount(invoices, invoices, policy.amount, original_if=only)
        sale = F.col("adjusted_sale")
    else:
        sale = amount("sale")

    calendar = dates.calendar_columns(F.col("invoice_ts"))
    rows = (
        invoices.withColumn("invoice_ts", event_time(invoices, policy))
        .select(
            scalars.clean_key(F.col("seller")).alias("mst_seller"),
            scalars.clean_key(F.col("buyer")).alias("mst_buyer"),
            calendar["report_date"].alias("report_date"),
            calendar["hour"].alias("hour"),
            sale.alias("total_sales"),
            amount("tax").alias("tax_amt"),
            amount("discount").alias("discount_amt"),
            amount("with_vat").alias("total_with_vat"),
            amount("without_vat").alias("total_without_vat"),
            F.col("payment").alias("payment_method"),
            F.col("transport"),
            F.coalesce(amount("adjusted_with_vat"), amount("adjusted_without_vat")).alias("adjusted_amount")
            if "adjusted_with_vat" in invoices.columns
            else F.lit(None).cast(policy.amount).alias("adjusted_amount"),
            F.coalesce(is_approved() if policy.approved_only else is_issued(), F.lit(False)).alias("counts"),
        )
        .filter(F.col("mst_seller").isNotNull() & F.col("report_date").isNotNull())
    )
    return rows.withColumns(
        {
            "is_night": scalars.in_hours(F.col("hour"), *scalars.NIGHT_HOURS),
            "is_core": scalars.in_hours(F.col("hour"), *scalars.CORE_HOURS),
            "tax_band": scalars.tax_band(
                scalars.tax_percent(F.col("tax_amt"), F.col("total_sales"), F.col("discount_amt"))
            ),
        }
    )
