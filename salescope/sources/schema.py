"""What the engine knows about the sales star schema."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---- fixed values: the names a sales data set is required to use ----
REQUIRED_TABLES = (
    "dim_campaigns",
    "dim_customers",
    "dim_dates",
    "dim_products",
    "dim_salespersons",
    "dim_stores",
    "fact_sales_denormalized",
    "fact_sales_normalized",
)
# The denormalized fact ships under another file name than the required one.
TABLE_ALIASES = {"dim_fact_sales_denormalized": "fact_sales_denormalized"}
SHORT_NAMES = {
    "campaigns": "dim_campaigns",
    "customers": "dim_customers",
    "dates": "dim_dates",
    "products": "dim_products",
    "salespersons": "dim_salespersons",
    "stores": "dim_stores",
    "fact_sales": "fact_sales_denormalized",
}
PRIMARY_KEYS = {
    "campaigns": ("campaign_sk", "campaign_id"),
    "customers": ("customer_sk", "customer_id"),
    "dates": ("date_sk",),
    "products": ("product_sk", "product_id"),
    "salespersons": ("salesperson_sk", "salesperson_id"),
    "stores": ("store_sk", "store_id"),
    "fact_sales": ("sales_sk", "sales_id"),
}
FOREIGN_KEYS = {
    "fact_sales": {
        "customer_sk": ("customers", "customer_sk"),
        "product_sk": ("products", "product_sk"),
        "store_sk": ("stores", "store_sk"),
        "salesperson_sk": ("salespersons", "salesperson_sk"),
        "campaign_sk": ("campaigns", "campaign_sk"),
        "sales_date": ("dates", "full_date"),
    }
}
REQUIRED_EVENT_COLUMNS = ("sales_id", "customer_sk", "product_sk", "total_amount")
# ---- end of fixed values ----

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("sales_id", T.StringType()),
        T.StructField("customer_sk", T.LongType()),
        T.StructField("product_sk", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("sales_date", T.TimestampNTZType()),
    ]
)
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)


@dataclass(frozen=True)
class StarSchema:
    """The seven logical tables; the fact is at sales-line grain."""

    fact_sales: DataFrame
    customers: DataFrame
    products: DataFrame
    stores: DataFrame
    salespersons: DataFrame
    campaigns: DataFrame
    dates: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    @classmethod
    def from_tables(cls, tables: dict[str, DataFrame]) -> StarSchema:
        """Pick the seven tables out of a loaded set, by long or short name."""
        found = {short: tables.get(long, tables.get(short)) for short, long in SHORT_NAMES.items()}
        missing = [SHORT_NAMES[short] for short, df in found.items() if df is None]
        if missing:
            raise ValueError(f"missing tables: {', '.join(missing)}")
        return cls(**found)


def missing_tables(tables) -> list[str]:
    return [name for name in REQUIRED_TABLES if name not in tables]
