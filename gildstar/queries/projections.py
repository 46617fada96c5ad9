"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.functions.keys import surrogate_key
from gildstar.functions.scalars import contains_text, count_true
from gildstar.operators.filters import non_blank, require
from gildstar.queries.registry import bronze, register, table
from gildstar.queries.sqltext import with_ctes


@register(
    "P1_P2_projection",
    """SELECT p_partkey AS app_id, p_name AS name, p_brand AS developer, p_type AS publisher FROM part""",
)
def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("app_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("developer"),
        F.col("p_type").alias("publisher"),
    )
    return renamed.select("*")


@register(
    "P3_null_keys",
    with_ctes("d_rows") + "SELECT load_id, app_id FROM d_rows WHERE app_id IS NOT NULL",
)
def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bronze(spark, sf_dir, "raw_details")
    return require(raw.select("load_id", F.expr("raw_data:appid::bigint").alias("app_id")), "app_id")


@register(
    "P4_key_never_null",
    with_ctes("d_rows")
    + "SELECT count(*) AS n_rows, count(*) FILTER (app_id IS NULL) AS n_null_parts, 0::BIGINT AS n_null_keys FROM d_rows",
)
def key_never_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why no filter on hashed keys is needed: hashing is NULL-safe."""
    rows = bronze(spark, sf_dir, "raw_details").select(
        F.expr("raw_data:appid::bigint").alias("app_id"), "ingested_at"
    )
    keyed = rows.withColumn("row_key", surrogate_key("app_id", "ingested_at"))
    return keyed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("app_id").isNull()).alias("n_null_parts"),
        F.count_if(F.col("row_key").isNull()).alias("n_null_keys"),
    )


@register(
    "P5_P6_text_filters",
    with_ctes("d_rows")
    + "SELECT load_id, genres, developer FROM d_rows WHERE trim(genres) <> '' AND developer IS NOT NULL",
)
def text_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze(spark, sf_dir, "raw_details").select(
        "load_id",
        F.expr("raw_data:genre::string").alias("genres"),
        F.expr("raw_data:developer::string").alias("developer"),
    )
    return require(non_blank(rows, "genres"), "developer")


@register(
    "P8_in_list",
    """SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_pressing,
              o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AS is_patient
       FROM orders WHERE o_orderstatus IN ('O', 'P')""",
)
def in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    pressing = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus").isin("O", "P"))
        .select("o_orderkey", pressing.alias("is_pressing"), (~pressing).alias("is_patient"))
    )


@register(
    "P9_predicates",
    with_ctes("s_rows")
    + """SELECT load_id, discount_pct > 10 AS is_on_sale,
                platform_windows OR platform_mac OR platform_linux AS has_any,
                CAST(platform_windows AS INTEGER) + CAST(platform_mac AS INTEGER)
                  + CAST(platform_linux AS INTEGER) >= 2 AS has_several,
                price_eur IS NOT NULL AND currency IS NOT NULL AS is_priced FROM s_rows""",
)
def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comparison with NULL kept, AND, OR, counts of flags."""
    rows = bronze(spark, sf_dir, "raw_store").select(
        "load_id",
        F.expr("raw_data:price_overview.discount_percent::bigint").alias("discount_pct"),
        F.expr("raw_data:price_overview.final::bigint").alias("final_cents"),
        F.expr("raw_data:price_overview.currency::string").alias("currency"),
        *[F.expr(f"raw_data:platforms.{p}::boolean").alias(p) for p in ("windows", "mac", "linux")],
    )
    return rows.select(
        "load_id",
        (F.col("discount_pct") > 10).alias("is_on_sale"),
        (F.col("windows") | F.col("mac") | F.col("linux")).alias("has_any"),
        (count_true("windows", "mac", "linux") >= 2).alias("has_several"),
        (F.col("final_cents").isNotNull() & F.col("currency").isNotNull()).alias("is_priced"),
    )


@register(
    "P10_ilike",
    with_ctes("d_rows")
    + "SELECT load_id, genres, coalesce(genres ILIKE '%INDIE%', false) AS is_indie FROM d_rows",
)
def ilike(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze(spark, sf_dir, "raw_details").select(
        "load_id", F.expr("raw_data:genre::string").alias("genres")
    )
    return rows.withColumn("is_indie", contains_text("genres", "INDIE"))


@register(
    "P11_sibling_alias",
    """SELECT l_orderkey, l_linenumber, round(net, 6) AS net, net >= 50000 AS is_large,
              CASE WHEN net >= 50000 THEN 'large' WHEN net >= 10000 THEN 'medium' ELSE 'small' END AS label
       FROM (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem)""",
)
def sibling_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A computed column reused by later columns of the same list."""
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("gs_lineitem")
    return spark.sql(
        """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS raw_net,
                  raw_net >= 50000 AS is_large,
                  CASE WHEN raw_net >= 50000 THEN 'large' WHEN raw_net >= 10000 THEN 'medium'
                       ELSE 'small' END AS label,
                  round(raw_net, 6) AS net
           FROM gs_lineitem"""
    ).drop("raw_net")
