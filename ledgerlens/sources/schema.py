"""Logical invoice columns and their physical names per source layout."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Physical column names of the named layout.
NAMED_LAYOUT: dict[str, str] = {
    "invoice_id": "id",
    "record_ts": "created_date",
    "status": "invoice_status",
    "adjust_type": "adjustment_type",
    "adjust_status": "adjusted_status",
    "seller": "tenant_tax_code_encrypted",
    "issue_ts": "issue_date",
    "buyer": "buyer_tax_code_encrypted",
    "transport": "delivery_vehicle",
    "buyer_name": "buyer_name",
    "buyer_address": "buyer_address",
    "tax": "total_vat_amount",
    "discount": "discount_amount",
    "settlement_discount": "settlement_discount_amount",
    "with_vat": "total_amount_with_vat",
    "without_vat": "total_amount_without_vat",
    "with_vat_foreign": "total_amount_with_vat_frn",
    "original_invoice": "original_invoice_no",
    "payment": "payment_type",
    "items": "list_product",
    "partition_month": "partition_month",
    "signed_ts": "signed_date_proc",
    "error_code": "error_code",
    "sale": "total_amount_with_vat_final_fx_trans",
    "adjusted_with_vat": "total_amount_with_vat_adj",
    "adjusted_without_vat": "total_amount_without_vat_adj",
}

# Physical column names of the positional layout.
POSITIONAL_LAYOUT: dict[str, str] = {
    "invoice_id": "col1",
    "record_ts": "col4",
    "status": "col9",
    "adjust_type": "col10",
    "adjust_status": "col11",
    "seller": "col21",
    "issue_ts": "col23",
    "buyer": "col29",
    "transport": "col30",
    "buyer_name": "col32",
    "buyer_address": "col33",
    "tax": "col47",
    "discount": "col48",
    "settlement_discount": "col49",
    "with_vat": "col52",
    "without_vat": "col53",
    "with_vat_foreign": "col55",
    "original_invoice": "col72",
    "payment": "col79",
    "items": "col94",
    "partition_month": "col129",
}


def to_logical(df: DataFrame, layout: Mapping[str, str] = NAMED_LAYOUT) -> DataFrame:
    """Select the known columns under their logical names; absent ones become null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{physical}`") if physical in present else F.lit(None).cast("string")).alias(logical)
            for logical, physical in layout.items()
        ]
    )
