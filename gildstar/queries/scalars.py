"""String, date, key, math and conditional scalars (S*, T*, M*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.operators.joins import lookup
from gildstar.queries.dataflows import details, store
from gildstar.functions.keys import date_key, default_key, surrogate_key
from gildstar.functions.scalars import (
    band,
    band_below,
    category,
    cents_to_money,
    coalesce_priority,
    csv_element,
    midpoint,
    parse_range,
    pct_change,
    safe_ratio,
    try_number,
)
from gildstar.plans.dimensions import GENRE_CATEGORIES, OTHER_CATEGORY, calendar_columns
from gildstar.plans.intermediate import LOWEST_REVIEW_BAND, PRICE_BANDS, REVIEW_BANDS, TOP_PRICE_BAND
from gildstar.queries.registry import bronze, publish, register, table
from gildstar.queries.sqltext import REVIEWS, calendar_sql, with_ctes


def _raw_details(spark: SparkSession, sf_dir: str, **paths: str) -> DataFrame:
    """Named ``path::type`` reads of the details payload, with the load id."""
    reads = [F.expr(f"raw_data:{path}").alias(name) for name, path in paths.items()]
    return bronze(spark, sf_dir, "raw_details").select("load_id", *reads)


@register(
    "S1_split_rows",
    with_ctes("d_rows")
    + "SELECT load_id, unnest(string_split(genres, ',')) AS piece FROM d_rows WHERE genres IS NOT NULL",
)
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_details(spark, sf_dir, genres="genre::string")
    return rows.select("load_id", F.explode(F.split("genres", ",", -1)).alias("piece"))


@register(
    "S2_S3_split_part",
    with_ctes("d_rows")
    + """SELECT load_id, trim(split_part(genres, ',', 1)) AS first_genre, trim(split_part(genres, ',', 2)) AS second_genre,
                trim(split_part(genres, ',', 9)) AS ninth_genre, split_part(owners_range, ' .. ', 2) AS upper_text
         FROM d_rows""",
)
def split_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_details(spark, sf_dir, genres="genre::string", owners="owners::string")
    return rows.select(
        "load_id",
        csv_element("genres", 1).alias("first_genre"),
        csv_element("genres", 2).alias("second_genre"),
        csv_element("genres", 9).alias("ninth_genre"),
        F.split_part("owners", F.lit(" .. "), F.lit(2)).alias("upper_text"),
    )


@register(
    "S4_S10_M4_M5_range",
    with_ctes("d_rows")
    + """SELECT load_id, owners_range, owners_min, owners_max, (owners_min + owners_max) / 2.0 AS owners_midpoint
         FROM d_rows""",
)
def owner_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range text to bounds (replace, split, tolerant cast) and their midpoint."""
    rows = _raw_details(spark, sf_dir, owners_range="owners::string")
    low, high = parse_range("owners_range")
    return rows.withColumns({"owners_min": low, "owners_max": high}).withColumn(
        "owners_midpoint", midpoint("owners_min", "owners_max")
    )


@register(
    "S7_S8_keys",
    with_ctes("d_rows")
    + """SELECT load_id, md5(coalesce(CAST(app_id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-'
                  || coalesce(developer, '_dbt_utils_surrogate_key_null_') || '-'
                  || coalesce(CAST(_ingested_at AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS row_key,
                md5('Unknown') AS default_key FROM d_rows""",
)
def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bronze(spark, sf_dir, "raw_details").select(
        "load_id",
        F.expr("raw_data:appid::bigint").alias("app_id"),
        F.expr("raw_data:developer::string").alias("developer"),
        "ingested_at",
    )
    return rows.select(
        "load_id",
        surrogate_key("app_id", "developer", "ingested_at").alias("row_key"),
        default_key("Unknown").alias("default_key"),
    )


@register(
    "T1_T2_date_key",
    """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, CAST(ts AS DATE) AS day FROM events""",
)
def date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id", date_key("ts").alias("date_key"), F.col("ts").cast("date").alias("day")
    )


@register(
    "T3_T7_S5_S6_calendar",
    f"""SELECT l_orderkey, l_linenumber, {calendar_sql('d')}
        FROM (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d FROM lineitem)""",
)
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar parts of every ship date: year to weekday, names, labels, flags."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("d")
    )
    return lines.select("l_orderkey", "l_linenumber", *calendar_columns("d"))


@register(
    "M1_money",
    with_ctes("d_rows")
    + "SELECT load_id, cents / 100.0 AS price, (cents + (k % 3) * 500) / 100.0 AS initial_price FROM d_rows",
)
def money(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_details(spark, sf_dir, price="price::bigint", initial_price="initialprice::bigint")
    return publish(
        rows.select(
            "load_id",
            cents_to_money("price").alias("price"),
            cents_to_money("initial_price").alias("initial_price"),
        )
    )


@register(
    "M2_M7_safe_ratio",
    with_ctes("d_rows")
    + """SELECT load_id, positive_reviews + negative_reviews AS total,
                CASE WHEN positive_reviews + negative_reviews <> 0
                     THEN round(positive_reviews / CAST(positive_reviews + negative_reviews AS DOUBLE), 6) END AS score
         FROM d_rows""",
)
def ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_details(spark, sf_dir, pos="positive::bigint", neg="negative::bigint")
    total = F.col("pos") + F.col("neg")
    return publish(
        rows.select("load_id", total.alias("total"), safe_ratio("pos", total).alias("score"))
    )


@register(
    "M3_pct_change",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice - l_quantity * 1000, 6) AS delta,
              CASE WHEN l_discount <> 0 THEN round((l_tax - l_discount) / l_discount * 100.0, 6) END AS pct
       FROM lineitem""",
)
def pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            (F.col("l_extendedprice") - F.col("l_quantity") * 1000).alias("delta"),
            pct_change("l_tax", "l_discount").alias("pct"),
        )
    )


@register(
    "M5_try_number",
    with_ctes("d_rows")
    + """SELECT load_id, CAST(TRY_CAST(split_part(load_id, '-', 2) AS DECIMAL(38, 0)) AS BIGINT) AS n,
                CAST(TRY_CAST(name AS DECIMAL(38, 0)) AS BIGINT) AS not_a_number FROM d_rows""",
)
def tolerant_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_details(spark, sf_dir, name="name::string")
    return rows.select(
        "load_id",
        try_number(F.split_part("load_id", F.lit("-"), F.lit(2))).alias("n"),
        try_number("name").alias("not_a_number"),
    )


@register(
    "M6_M14_round_cast",
    """SELECT o_orderkey, round(o_totalprice, 0) AS whole, CAST(o_orderdate AS DATE) AS day,
              CAST(o_custkey AS VARCHAR) AS cust_text, CAST(o_orderkey AS DOUBLE) AS key_float,
              CAST(o_orderstatus = 'O' AS INTEGER) AS is_open FROM orders""",
)
def round_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.round("o_totalprice", 0).alias("whole"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_custkey").cast("string").alias("cust_text"),
        F.col("o_orderkey").cast("double").alias("key_float"),
        (F.col("o_orderstatus") == "O").cast("int").alias("is_open"),
    )


@register(
    "M8_M9_M13_coalesce",
    with_ctes("stg_details", "stg_store")
    + """SELECT d.app_id, coalesce(s.name, d.name) AS name, coalesce(s.developer, d.developer) AS developer,
                coalesce(s.platform_windows, false) AS platform_windows,
                coalesce(s.is_free, d.cents = 0) AS is_free
         FROM stg_details d LEFT JOIN stg_store s ON s.app_id = d.app_id""",
)
def priority_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First non-NULL of several sources, constants, and a comparison as fallback."""
    st = store(spark, sf_dir).select(
        "app_id", F.struct("name", "developer", "platform_windows", "is_free").alias("st")
    )
    both = lookup(details(spark, sf_dir), st, ["app_id"])
    merged = coalesce_priority({"name": ["st.name", "name"], "developer": ["st.developer", "developer"]})
    return both.select(
        "app_id",
        *merged,
        F.coalesce("st.platform_windows", F.lit(False)).alias("platform_windows"),
        F.coalesce(F.col("st.is_free"), F.col("price_usd") == 0).alias("is_free"),
    )


@register(
    "M10_bands",
    f"""SELECT o_orderkey, {REVIEWS.format(value='score')} AS label
        FROM (SELECT o_orderkey, o_totalprice / 500000 AS score FROM orders)""",
)
def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.col("o_totalprice") / F.lit(500000)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", band(score, REVIEW_BANDS, LOWEST_REVIEW_BAND).alias("label")
    )


@register(
    "M11_bands_below",
    """SELECT p_partkey, p_retailprice,
              CASE WHEN p_size = 1 THEN 'free'
                   WHEN price < 5 THEN 'budget'
                   WHEN price < 20 THEN 'mid'
                   WHEN price < 40 THEN 'premium'
                   ELSE 'aaa' END AS tier
        FROM (SELECT *, p_retailprice / 20 * p_size / 50 AS price FROM part)""",
)
def bands_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice") / 20 * F.col("p_size") / 50
    tier = band_below(price, PRICE_BANDS, TOP_PRICE_BAND, override=(F.col("p_size") == 1, "free"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", tier.alias("tier"))


@register(
    "M12_category",
    with_ctes("d_rows", "dim_genre")
    + """SELECT load_id, ifnull(genre_category, 'other') AS kind
         FROM (SELECT load_id, trim(split_part(genres, ',', 2)) AS genre_name FROM d_rows)
         LEFT JOIN dim_genre USING (genre_name)""",
)
def membership_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_details(spark, sf_dir, genres="genre::string")
    kind = category(csv_element("genres", 2), GENRE_CATEGORIES, OTHER_CATEGORY)
    return rows.select("load_id", kind.alias("kind"))
