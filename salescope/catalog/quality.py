"""Cleaning, validation and profiling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.catalog.registry import as_days, query, rounded, star_sql
from salescope.functions.columns import string_columns
from salescope.operators import cleaning, distribution, profiling, validation
from salescope.plans import datasets
from salescope.session import written
from salescope.sources import adapter
from salescope.sources.schema import StarSchema


def _messy_customers(spark, folder):
    """The customers twice, with padded names: cleaning must bring back one of each."""
    base = adapter.table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(float("inf")))
        .otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit("no date"))
        .otherwise(F.lit("1997-03-04")).alias("signup_date"),
    )
    return base.unionByName(base)


@query(
    "clean_tables",
    """SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name,
      CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
      CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE DATE '1997-03-04' END AS signup_date
    FROM customer""",
)
def clean_tables(spark, folder):
    return as_days(cleaning.clean_dataframe(_messy_customers(spark, folder)), "signup_date")


#: table -> its columns in the SQL below; all of them are cleaned, text is padded before.
STAR_TEXT = {
    "fact_sales": (),
    "customers": ("customer_id", "first_name", "last_name", "customer_segment"),
    "products": ("product_id", "product_name", "category", "brand", "origin_location"),
    "stores": ("store_id", "state", "region"),
    "salespersons": ("salesperson_id",),
    "campaigns": ("campaign_id",),
    "dates": (),
}


def _messy(df):
    """Every row twice, text padded."""
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name != "sales_sk"]
    padded = df.withColumns({c: F.concat(F.lit("  "), c, F.lit(" ")) for c in text})
    return padded.unionByName(padded)


@query(
    "clean_star_tables",
    star_sql(
        " UNION ALL ".join(
            f"""SELECT '{t}' AS table_name, 2 * count(*) AS rows_in,
            (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS rows_out,
            CAST({" + ".join(f"coalesce(sum(length(trim({c}))), 0)" for c in cs) or "0"} AS BIGINT) AS text_length,
            CAST({" + ".join(f"count_if({c} IS NULL)" for c in cs) or "0"} AS BIGINT) AS nulls FROM {t}"""
            for t, cs in STAR_TEXT.items()
        )
    ),
)
def clean_star_tables(spark, folder):
    """All seven tables, doubled and padded, cleaned in one go; what is left of each."""
    tables = adapter.star(spark, folder).tables()
    messy = {name: _messy(df) for name, df in tables.items()}
    clean = cleaning.clean_star(StarSchema(**messy)).tables()
    parts = []
    for name, text in STAR_TEXT.items():
        rows = messy[name].agg(F.count(F.lit(1)).alias("rows_in")).scalar()
        length = sum((F.coalesce(F.sum(F.length(c)), F.lit(0)) for c in text), F.lit(0).cast("long"))
        nulls = sum((F.count_if(F.col(c).isNull()) for c in text), F.lit(0).cast("long"))
        parts.append(
            clean[name]
            .agg(F.count(F.lit(1)).alias("rows_out"), length.alias("text_length"), nulls.alias("nulls"))
            .select(F.lit(name).alias("table_name"), rows.alias("rows_in"), "rows_out", "text_length", "nulls")
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def _gappy_customers(spark, folder):
    """Customers with missing figures and segments, each row twice."""
    base = adapter.table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")).alias("target"),
    )
    return base.unionByName(base)


def _gap_sql(target):
    gaps = """SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS c_acctbal,
      CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS c_mktsegment,
      CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS target FROM customer"""
    return f"""WITH gaps AS ({gaps})
      SELECT c_custkey, round(coalesce(c_acctbal, (SELECT quantile_cont(c_acctbal, 0.5)
        FROM gaps)), 6) AS c_acctbal, coalesce(c_mktsegment, 'Unknown') AS c_mktsegment,
        round({target}, 6) AS target FROM gaps"""


@query("clean_ml", _gap_sql("target"))
def clean_ml(spark, folder):
    out = cleaning.clean_ml_dataframe(_gappy_customers(spark, folder), ["target"])
    return rounded(out, "c_acctbal", "target")


@query("clean_raw", _gap_sql("coalesce(target, (SELECT quantile_cont(target, 0.5) FROM gaps))"))
def clean_raw(spark, folder):
    out = cleaning.clean_feature_dataset_raw(_gappy_customers(spark, folder))
    return rounded(out, "c_acctbal", "target")


# table -> key columns, in the SQL below
KEYS = {
    "campaigns": ("campaign_sk", "campaign_id"),
    "customers": ("customer_sk", "customer_id"),
    "dates": ("date_sk",),
    "products": ("product_sk", "product_id"),
    "salespersons": ("salesperson_sk", "salesperson_id"),
    "stores": ("store_sk", "store_id"),
    "fact_sales": ("sales_sk", "sales_id"),
}
PK_CTE = "pk AS (" + " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, '{c}' AS column_name,
    CAST(count_if({c} IS NULL) AS BIGINT) AS nulls,
    count(*) - (count(DISTINCT {c}) + CAST(max(CAST({c} IS NULL AS INTEGER)) AS BIGINT))
      AS duplicates FROM {t}"""
    for t, cs in KEYS.items()
    for c in cs
) + ")"
LINKS = (
    ("customer_sk", "customers", "customer_sk"),
    ("product_sk", "products", "product_sk"),
    ("store_sk", "stores", "store_sk"),
    ("salesperson_sk", "salespersons", "salesperson_sk"),
    ("campaign_sk", "campaigns", "campaign_sk"),
    ("sales_date", "dates", "full_date"),
)
FK_CTE = "fk AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, '{t}' AS parent_table, count(*) AS missing FROM fact_sales
    WHERE {'CAST(sales_date AS DATE)' if c == 'sales_date' else c} NOT IN (SELECT {k} FROM {t})"""
    for c, t, k in LINKS
) + ")"
RULES_CTE = """rules AS (
  SELECT 'campaign_ends_after_start' AS rule, CAST(count_if(end_date_sk < start_date_sk) AS BIGINT)
    AS bad_rows FROM campaigns
  UNION ALL SELECT 'amount_not_negative', CAST(count_if(total_amount < 0) AS BIGINT)
  FROM fact_sales)"""


@query(
    "pk_check",
    star_sql("SELECT *, nulls = 0 AND duplicates = 0 AS passed FROM pk", PK_CTE),
)
def pk_check(spark, folder):
    parts = [
        validation.validate_primary_keys(df, name)
        for name, df in adapter.star(spark, folder).tables().items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("fk_check", star_sql("SELECT *, missing = 0 AS passed FROM fk", FK_CTE))
def fk_check(spark, folder):
    return validation.validate_foreign_keys(adapter.star(spark, folder))


@query("business_rules", star_sql("SELECT *, bad_rows = 0 AS passed FROM rules", RULES_CTE))
def business_rules(spark, folder):
    return validation.validate_business_rules(adapter.star(spark, folder))


@query(
    "star_validation",
    star_sql(
        """SELECT 'primary_key' AS "check", table_name || '.' || column_name AS subject,
          nulls + duplicates AS bad_rows, nulls = 0 AND duplicates = 0 AS passed FROM pk
        UNION ALL SELECT 'foreign_key', column_name, missing, missing = 0 FROM fk
        UNION ALL SELECT 'business_rule', rule, bad_rows, bad_rows = 0 FROM rules""",
        PK_CTE,
        FK_CTE,
        RULES_CTE,
    ),
)
def star_validation(spark, folder):
    return validation.validate_star_schema(adapter.star(spark, folder))


# Every feature table and model data set as a view, and its columns.
FEATURE_COLUMNS = {
    "customer_features": "customer_sk total_orders total_spent average_order_value first_purchase_date"
    " last_purchase_date products_purchased stores_used campaigns_used customer_lifetime_days"
    " days_since_last_purchase customer_segment",
    "product_features": "product_sk total_units_sold total_revenue average_sales_value customers_purchased"
    " stores_sold_in category brand",
    "daily_features": "date daily_revenue transaction_count day_of_week month quarter rolling_7_day_average"
    " rolling_30_day_average",
    "interactions": "customer_sk product_sk purchase_count total_spent average_spend",
}
DATASET_COLUMNS = {
    "churn": FEATURE_COLUMNS["customer_features"] + " first_name last_name churn_label",
    "ltv": FEATURE_COLUMNS["customer_features"] + " customer_ltv",
    "demand": FEATURE_COLUMNS["product_features"] + " product_name origin_location",
    "forecast": FEATURE_COLUMNS["daily_features"] + " full_date year weekday future_revenue",
    "recommendation": FEATURE_COLUMNS["interactions"],
}
VIEWS_SQL = (
    "ltv AS (SELECT *, total_spent AS customer_ltv FROM customer_features)",
    """demand AS (SELECT pf.*, product_name, origin_location
      FROM product_features pf LEFT JOIN products USING (product_sk))""",
    "recommendation AS (SELECT * FROM interactions)",
)


def _columns_sql(views, select):
    return " UNION ALL ".join(
        select.format(view=view, column=column) for view, columns in views.items() for column in columns.split()
    )


PROFILE_SQL = (
    "profile AS ("
    + _columns_sql(
        DATASET_COLUMNS,
        """SELECT '{view}' AS dataset, '{column}' AS column_name, count(*) AS row_count,
          CAST(count_if({column} IS NULL) AS BIGINT) AS nulls, count(DISTINCT {column}) AS distinct_values,
          (SELECT max(c) FROM (SELECT count(*) AS c FROM {view} GROUP BY {column})) AS top_count,
          (SELECT any_value(typeof({column})) FROM {view}) = 'VARCHAR' AS is_text FROM {view}""",
    )
    + ")"
)
ROLES_SQL = "roles AS (SELECT * FROM (VALUES {}) r(dataset, column_name, role))".format(
    ", ".join(
        [f"('{d}', '{c}', 'target')" for d in DATASET_COLUMNS for c in datasets.TARGETS[d]]
        + [f"('{d}', '{c}', 'protected')" for d in DATASET_COLUMNS for c in sorted(datasets.protected_columns(d))]
    )
)


def _of_all(spark, folder, look):
    """What ``look(name, frame)`` finds in every model data set; None where there is nothing to look at."""
    from salescope.catalog.datasets import all_datasets

    parts = []
    for name, frame in all_datasets(spark, folder).items():
        frame = as_days(frame, *[c for c, kind in frame.dtypes if kind.startswith("timestamp")])
        found = look(name, frame)
        if found is not None:
            parts.append(found.withColumn("dataset", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


@query(
    "ml_dataset_check",
    star_sql(
        """SELECT dataset, 'rows' AS "check", '' AS subject, max(row_count) AS value FROM profile GROUP BY dataset
        UNION ALL SELECT dataset, 'columns', '', count(*) FROM profile GROUP BY dataset
        UNION ALL SELECT dataset, 'null_cells', '', CAST(sum(nulls) AS BIGINT) FROM profile GROUP BY dataset
        UNION ALL """
        + " UNION ALL ".join(
            f"""SELECT '{d}', 'duplicate_rows', '',
            (SELECT count(*) FROM {d}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {d}))"""
            for d in DATASET_COLUMNS
        )
        + """ UNION ALL SELECT dataset, 'constant', column_name, distinct_values FROM profile WHERE distinct_values <= 1
        UNION ALL SELECT dataset, 'target_values', column_name, distinct_values
          FROM profile JOIN roles USING (dataset, column_name) WHERE role = 'target'""",
        *VIEWS_SQL,
        PROFILE_SQL,
        ROLES_SQL,
    ),
)
def ml_dataset_check(spark, folder):
    return _of_all(spark, folder, lambda name, df: profiling.validate_ml_dataframe(df, datasets.TARGETS[name]))


_STATS_SQL = """SELECT '{view}' AS dataset, '{column}' AS column_name,
  replace(replace(lower((SELECT any_value(typeof({column})) FROM {view})), 'varchar', 'string'), 'integer', 'int') AS type,
  count(*) AS row_count, CAST(count_if({column} IS NULL) AS BIGINT) AS nulls,
  count(DISTINCT {column}) AS distinct_values,
  CASE WHEN n THEN count({column}) END AS count, round(avg(x), 2) AS mean, round(stddev_samp(x), 2) AS std,
  min(x) AS min, max(x) AS max, round(skewness(x), 4) AS skew, round(quantile_cont(x, 0.25), 4) AS p25,
  round(quantile_cont(x, 0.5), 4) AS p50, round(quantile_cont(x, 0.75), 4) AS p75
  FROM (SELECT {column}, typeof({column}) IN ('BIGINT', 'INTEGER', 'DOUBLE') AS n,
    CASE WHEN typeof({column}) IN ('BIGINT', 'INTEGER', 'DOUBLE') THEN TRY_CAST(CAST({column} AS VARCHAR) AS DOUBLE) END AS x
    FROM {view}) GROUP BY n"""


@query("feature_profile", star_sql(_columns_sql(FEATURE_COLUMNS, _STATS_SQL)))
def feature_profile(spark, folder):
    """All columns of the four feature tables."""
    from salescope.catalog.datasets import feature_frames

    parts = []
    for name, df in feature_frames(spark, folder).items():
        df = as_days(df, *[c for c, kind in df.dtypes if kind.startswith("timestamp")])
        parts.append(profiling.inspect_dataset(written(df, name)).withColumn("dataset", F.lit(name)))
    found = rounded(reduce(DataFrame.unionByName, parts), "skew", "p25", "p50", "p75", digits=4)
    return rounded(found, "mean", "std", digits=2)


@query(
    "constant_columns",
    star_sql(
        """SELECT dataset, column_name, distinct_values, top_count FROM profile
        WHERE (distinct_values + CAST(nulls > 0 AS INTEGER) <= 1 OR top_count >= row_count * 0.99)
          AND (dataset, column_name) NOT IN (SELECT dataset, column_name FROM roles WHERE role = 'protected')""",
        *VIEWS_SQL,
        PROFILE_SQL,
        ROLES_SQL,
    ),
)
def constant_columns(spark, folder):
    def look(name, df):
        found = profiling.constant_columns(profiling.column_profile(df), datasets.protected_columns(name))
        return found.select("column_name", "distinct_values", "top_count")

    return _of_all(spark, folder, look)


@query(
    "high_cardinality_columns",
    star_sql(
        """SELECT dataset, column_name, distinct_values FROM profile
        WHERE is_text AND distinct_values >= row_count * 0.95""",
        *VIEWS_SQL,
        PROFILE_SQL,
    ),
)
def high_cardinality_columns(spark, folder):
    def look(name, df):
        text = string_columns(df)
        if not text:
            return None  # and the data set is not built for it
        # Only text is judged, so only text is counted.
        found = profiling.high_cardinality_columns(profiling.column_profile(df.select(*text)), text)
        return found.select("column_name", "distinct_values")

    return _of_all(spark, folder, look)


@query(
    "target_distribution",
    star_sql(
        " UNION ALL ".join(
            f"""SELECT '{d}' AS dataset, '{c}' AS target, CAST({c} AS DOUBLE) AS value, count(*) AS n
            FROM {d} GROUP BY {c}"""
            for d in DATASET_COLUMNS
            for c in datasets.TARGETS[d]
        ),
        *VIEWS_SQL,
    ),
)
def target_distribution(spark, folder):
    """How often every value of every target occurs."""
    from salescope.catalog.datasets import all_datasets

    parts, frames = [], all_datasets(spark, folder)
    for name, targets in datasets.TARGETS.items():
        frame = frames[name]
        for target in targets:
            found = distribution.target_distribution(frame, target)
            value = F.col(target).cast("double").alias("value")
            parts.append(found.select(F.lit(name).alias("dataset"), F.lit(target).alias("target"), value, "n"))
    return reduce(DataFrame.unionByName, parts)
