"""Bronze-shaped rows derived from the generic ``part`` and ``events`` tables.

Narrow projections only, so they scale with their input.  Integer arithmetic
and text, chosen so that the edge cases of the payloads occur: repeated loads,
ties, missing keys, quoted numbers, empty and absent sub-documents.  ``spread``
cuts an input of too few splits into ranges before the JSON is generated; ranges
of time keep each day in few tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Apps that no details table knows get ids above this.
UNKNOWN_APP_OFFSET = 1_000_000_000_000


def _table(spark: SparkSession, sf_dir: str, name: str, spread: int | None, by: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.repartitionByRange(spread, by) if spread else df


def raw_details(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    """One to three loads per part, with a text payload."""
    loads = _table(spark, sf_dir, "part", spread, "p_partkey").select(
        F.col("p_partkey").alias("k"),
        F.col("p_size").alias("z"),
        "p_name",
        "p_brand",
        "p_type",
        F.explode(F.expr("sequence(0, p_size % 3)")).alias("v"),
    )
    valued = loads.selectExpr(
        "*",
        "CASE WHEN k % 7 = 0 THEN 0 ELSE (k * 137 + v * 250) % 6000 END AS cents",
        "z % 8 AS n_tags",
    ).selectExpr(
        "*",
        """CASE WHEN n_tags > 0 THEN concat('{', array_join(transform(sequence(0, n_tags - 1), i ->
               concat('"tag', (k + i) % 11, '":',
                      if(i % 2 = 1, concat('"', (k * (i + 3) * 7) % 50, '"'), cast((k * (i + 3) * 7) % 50 AS string)))
           ), ','), '}')
           WHEN z = 8 THEN '{}' WHEN z = 16 THEN '[]' WHEN z = 24 THEN 'null' END AS tags""",
        """to_json(named_struct(
             'appid', CASE WHEN p_brand = 'Brand#7' AND v = 0 AND z % 3 > 0 THEN NULL ELSE k END,
             'name', p_name,
             'developer', CASE WHEN z <> 13 THEN p_brand END,
             'publisher', p_type,
             'price', cast(cents AS string),
             'initialprice', cast(cents + (k % 3) * 500 AS string),
             'discount', CASE WHEN k % 13 <> 0 THEN (k % 4) * 10 END,
             'ccu', z * 10,
             'average_forever', k % 1000,
             'average_2weeks', k % 100,
             'median_forever', k % 500,
             'median_2weeks', k % 50,
             'positive', CASE WHEN k % 11 = 0 THEN 0 WHEN k % 37 <> 4 THEN (k * 31) % 5000 END,
             'negative', CASE WHEN k % 11 = 0 THEN 0 ELSE (k * 17) % 900 END,
             'owners', CASE WHEN z = 11 THEN 'n/a' WHEN z = 12 THEN NULL WHEN z = 14 THEN '5000'
                       ELSE concat(format_number(z * 10000, 0), ' .. ', format_number(z * 20000, 0)) END,
             'genre', CASE WHEN p_type = 'SMALL' AND z % 2 = 0 THEN 'Action, Free To Play, '
                           WHEN p_type = 'PROMO' AND z % 5 = 0 THEN ''
                           WHEN z = 17 THEN NULL
                           WHEN z % 4 = 0 THEN concat(p_type, ', Indie')
                           ELSE concat(p_type, ', ', split_part(p_name, ' ', 2)) END,
             'languages', 'English, French')) AS body""",
    )
    return valued.selectExpr(
        "concat('details-', k, '-', v) AS load_id",
        """CASE WHEN p_brand = 'Brand#5' AND v = 0 THEN NULL
                WHEN p_brand = 'Brand#3' THEN timestamp_ntz'2024-01-01 06:00:00'
                ELSE timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(v) END AS ingested_at""",
        "'details_api' AS source",
        "'appdetails' AS endpoint",
        "k AS appid",
        "if(tags IS NULL, body, concat(left(body, length(body) - 1), ',\"tags\":', tags, '}')) AS raw_data",
    )


def raw_store(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    """One or two loads for every part that is not of type STANDARD."""
    loads = (
        _table(spark, sf_dir, "part", spread, "p_partkey")
        .filter("p_type <> 'STANDARD'")
        .select(
            F.col("p_partkey").alias("k"),
            F.col("p_size").alias("z"),
            "p_name",
            "p_brand",
            "p_type",
            F.explode(F.expr("sequence(0, if(p_size > 40, 1, 0))")).alias("v"),
        )
    )
    return loads.selectExpr(
        "concat('store-', k, '-', v) AS load_id",
        "timestamp_ntz'2024-01-02 00:00:00' + make_dt_interval(v) AS ingested_at",
        "'store_api' AS source",
        "'appdetails' AS endpoint",
        "k AS appid",
        "'es' AS country_code",
        """to_json(named_struct(
             'appid', k,
             'name', CASE WHEN z % 2 = 0 THEN concat('Store ', p_name) ELSE p_name END,
             'type', CASE WHEN z % 10 = 0 THEN 'dlc' ELSE 'game' END,
             'short_description', concat('About ', p_name),
             'developers', CASE WHEN z % 6 = 0 THEN array() WHEN z % 6 = 1 THEN NULL
                                ELSE array(p_brand, concat('Co ', p_brand)) END,
             'publishers', array(p_type),
             'price_overview', CASE WHEN k % 7 <> 0 THEN named_struct(
                 'currency', 'EUR',
                 'final', ((k * 137) % 6000) * 9 div 10,
                 'initial', (k * 137) % 6000,
                 'discount_percent', 10 + v * 5) END,
             'is_free', k % 7 = 0 AND k % 21 <> 0,
             'release_date', named_struct('coming_soon', z = 1, 'date', '21 Aug, 2012'),
             'genres', CASE WHEN z = 2 THEN NULL
                            WHEN z % 9 = 0 THEN array(named_struct('id', '1', 'description', p_type),
                                                      named_struct('id', '70', 'description', 'Early Access'))
                            ELSE array(named_struct('id', '1', 'description', p_type)) END,
             'categories', array(named_struct('id', 2, 'description', 'Single-player')),
             'platforms', named_struct('windows', z % 2 = 1, 'mac', (z div 2) % 2 = 1, 'linux', (z div 4) % 2 = 1),
             'supported_languages', 'English<strong>*</strong>',
             'website', CASE WHEN z % 2 = 0 THEN concat('http://example.com/', k) END)) AS raw_data""",
    )


def raw_players(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    """One snapshot per event; error events belong to apps nobody knows."""
    return _table(spark, sf_dir, "events", spread, "ts").selectExpr(
        "concat('players-', event_id) AS load_id",
        "ts + interval 1 minute AS ingested_at",
        "'web_api' AS source",
        f"CASE WHEN event_type = 'error' THEN user_id + {UNKNOWN_APP_OFFSET} ELSE user_id END AS appid",
        "cast(floor(value * 100) AS bigint) AS player_count",
        "ts AS snapshot_at",
        """to_json(named_struct(
             'players', named_struct('player_count',
                 cast(floor(value * 100) AS bigint) + if(event_type = 'signup', 1, 0)),
             'achievements', CASE
                 WHEN cast(floor(value) AS bigint) % 4 = 0 AND event_type = 'view' THEN NULL
                 ELSE named_struct('achievements', transform(
                     filter(array(0, 1, 2), i -> i < cast(floor(value) AS bigint) % 4),
                     i -> named_struct(
                         'name', CASE WHEN event_type = 'purchase' AND i = 2 THEN NULL
                                      ELSE concat(event_type, '_', i) END,
                         'percent', CASE WHEN event_type = 'click' AND i = 1 THEN NULL
                                         ELSE (value * ((i + 1) * 7)) % 100 END))) END)) AS raw_data""",
    )


RAW_TABLES = {"raw_details": raw_details, "raw_store": raw_store, "raw_players": raw_players}
