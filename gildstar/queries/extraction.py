"""Semi-structured extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.functions.variant import array_has, field
from gildstar.operators.extract import explode_array, explode_object, extract
from gildstar.plans.staging import ACHIEVEMENT_FIELDS
from gildstar.queries.registry import bronze, publish, register, table
from gildstar.queries.sqltext import with_ctes


@register(
    "J1_typed_paths",
    r"""SELECT event_id, CAST(regexp_extract(props, '"k":\s*(\d+)', 1) AS BIGINT) AS k,
               CAST(regexp_extract(props, '"k":\s*(\d+)', 1) AS VARCHAR) AS k_text FROM events""",
)
def typed_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("doc"))
    spec = {"k": ("$.k", "bigint"), "k_text": ("$.k", "string")}
    return extract(events, "doc", spec, keep=["event_id"])


@register(
    "J1_quoted_numbers",
    with_ctes("d_rows")
    + """SELECT load_id, app_id, cents AS price, cents + (k % 3) * 500 AS initial_price, discount_pct,
                positive_reviews, negative_reviews FROM d_rows""",
)
def quoted_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that arrive as text, and paths that are missing."""
    spec = {
        "app_id": ("$.appid", "bigint"),
        "price": ("$.price", "bigint"),
        "initial_price": ("$.initialprice", "bigint"),
        "discount_pct": ("$.discount", "bigint"),
        "positive_reviews": ("$.positive", "bigint"),
        "negative_reviews": ("$.negative", "bigint"),
    }
    return extract(bronze(spark, sf_dir, "raw_details"), "raw_data", spec, keep=["load_id"])


@register(
    "J2_nested_paths",
    with_ctes("s_rows")
    + """SELECT load_id, currency, CASE WHEN k % 7 <> 0 THEN ((k * 137) % 6000) * 9 // 10 END AS final_cents,
                discount_pct, release_date_raw AS release_date, is_coming_soon,
                platform_windows AS windows, platform_mac AS mac, platform_linux AS linux FROM s_rows""",
)
def nested_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {
        "currency": ("$.price_overview.currency", "string"),
        "final_cents": ("$.price_overview.final", "bigint"),
        "discount_pct": ("$.price_overview.discount_percent", "int"),
        "release_date": ("$.release_date.date", "string"),
        "is_coming_soon": ("$.release_date.coming_soon", "boolean"),
        "windows": ("$.platforms.windows", "boolean"),
        "mac": ("$.platforms.mac", "boolean"),
        "linux": ("$.platforms.linux", "boolean"),
    }
    df = extract(bronze(spark, sf_dir, "raw_store"), "raw_data", spec, keep=["load_id"])
    return df.withColumn("discount_pct", F.col("discount_pct").cast("bigint"))


@register(
    "J3_first_element",
    with_ctes("s_rows") + "SELECT load_id, developer, publisher FROM s_rows",
)
def first_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = {"developer": ("$.developers[0]", "string"), "publisher": ("$.publishers[0]", "string")}
    return extract(bronze(spark, sf_dir, "raw_store"), "raw_data", spec, keep=["load_id"])


@register(
    "J4_sub_document",
    with_ctes("d_rows", "d_tags")
    + """SELECT d.load_id, n_tags > 0 OR z IN (8, 16, 24) AS has_tags, t.votes AS tag3_votes
         FROM d_rows d LEFT JOIN d_tags t ON t.load_id = d.load_id AND t.tag = 'tag3'""",
)
def sub_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep a nested object whole, then read from it."""
    kept = extract(
        bronze(spark, sf_dir, "raw_details"), "raw_data", {"tags": ("$.tags", "variant")}, ["load_id"]
    )
    return kept.select(
        "load_id",
        F.col("tags").isNotNull().alias("has_tags"),
        field("tags", "$.tag3", "bigint").alias("tag3_votes"),
    )


@register(
    "J5_explode_array",
    with_ctes("ach_all")
    + "SELECT app_id, snapshot_at, achievement_name, round(unlock_pct, 6) AS unlock_pct FROM ach_all",
)
def array_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bronze(spark, sf_dir, "raw_players")
    keep = [F.col("appid").alias("app_id"), "snapshot_at"]
    return publish(
        explode_array(raw, "raw_data", "$.achievements.achievements", ACHIEVEMENT_FIELDS, keep)
    )


@register(
    "J6_J8_explode_object",
    with_ctes("d_tags") + "SELECT load_id, tag, votes FROM d_tags",
)
def object_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with quoted and bare values; {}, [], null and absent give no rows."""
    raw = bronze(spark, sf_dir, "raw_details")
    return explode_object(raw, "raw_data", "bigint", "$.tags", ["load_id"], "tag", "votes")


@register(
    "J7_array_has",
    with_ctes("s_rows") + "SELECT load_id, is_early_access FROM s_rows",
)
def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = array_has("raw_data", "$.genres", "description", "Early Access")
    return bronze(spark, sf_dir, "raw_store").select("load_id", flag.alias("is_early_access"))
