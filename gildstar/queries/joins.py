"""Joins and star assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.operators.extract import explode_object
from gildstar.functions.keys import date_key, default_key
from gildstar.functions.scalars import csv_element
from gildstar.operators.joins import Dim, enrich, lookup, star_join
from gildstar.plans.dimensions import dim_date, dim_games, dim_genre
from gildstar.queries.dataflows import details, snapshots, stored_games
from gildstar.queries.registry import bronze, register, table
from gildstar.queries.sqltext import with_ctes


@register(
    "N1_left_enrichment",
    """SELECT o_orderkey, c_name, c_mktsegment, n.n_lines FROM orders
       LEFT JOIN customer ON c_custkey = o_custkey
       LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey) n
              ON n.l_orderkey = o_orderkey""",
)
def left_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    named = enrich(orders, [customer], ["c_custkey"])
    return enrich(named, [lines], ["o_orderkey"]).drop("c_custkey")


@register(
    "N2_left_keeps_unknown",
    with_ctes("players", "stg_details")
    + """SELECT p.app_id, p.snapshot_at, d.name FROM players p LEFT JOIN stg_details d ON d.app_id = p.app_id""",
)
def keeps_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = snapshots(spark, sf_dir).select("app_id", "snapshot_at")
    return lookup(series, details(spark, sf_dir).select("app_id", "name"), ["app_id"], "left")


@register(
    "N3_inner_drops_unknown",
    with_ctes("players", "stg_details")
    + """SELECT p.app_id, p.snapshot_at, d.name FROM players p JOIN stg_details d ON d.app_id = p.app_id""",
)
def drops_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = snapshots(spark, sf_dir).select("app_id", "snapshot_at")
    return lookup(series, details(spark, sf_dir).select("app_id", "name"), ["app_id"], "inner")


@register(
    "N4_dimension_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_brand, s_name FROM lineitem
       LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey""",
)
def dimension_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = star_join(
        lines,
        [
            Dim(table(spark, sf_dir, "part"), "p_partkey", "p_brand", F.col("l_partkey")),
            Dim(table(spark, sf_dir, "supplier"), "s_suppkey", "s_name", F.col("l_suppkey")),
        ],
    )
    return out.drop("l_suppkey")


@register(
    "N4_lookup_hot_keys",
    """SELECT event_id, event_type, ts, first_ts FROM events
       LEFT JOIN (SELECT event_type, min(ts) AS first_ts FROM events GROUP BY event_type) f USING (event_type)""",
)
def lookup_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event type is hot: salted on the left, repeated per salt on the right."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    first = events.groupBy("event_type").agg(F.min("ts").alias("first_ts"))
    return lookup(events, first, ["event_type"], rows_per_task=50, broadcast_bytes=0)


@register(
    "N5_P7_current_only",
    with_ctes("dim_games", "players")
    + """SELECT p.app_id, p.snapshot_at, g.game_key, g.price_tier FROM players p
         LEFT JOIN dim_games g ON g.app_id = p.app_id AND g.is_current""",
)
def current_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constant predicate on the right of a left join: filter first, then join."""
    games = dim_games(stored_games(spark, sf_dir))
    dim = Dim(
        games, "app_id", "game_key", F.col("app_id"), where=F.col("is_current"),
        carry={"price_tier": "price_tier"},
    )
    series = snapshots(spark, sf_dir).select("app_id", "snapshot_at")
    return star_join(series, [dim])


@register(
    "N6_computed_key",
    with_ctes("dim_date")
    + """SELECT event_id, d.date_key, d.is_weekend FROM events
         LEFT JOIN dim_date d ON d.date_key = CAST(strftime(ts, '%Y%m%d') AS INTEGER)""",
)
def computed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = Dim(
        dim_date(spark), "date_key", "date_key", date_key("ts"), carry={"is_weekend": "is_weekend"}
    )
    return star_join(table(spark, sf_dir, "events").select("event_id", "ts"), [dim]).drop("ts")


@register(
    "N7_N8_text_key_default",
    with_ctes("games", "dim_genre")
    + """SELECT app_id, coalesce(gn.genre_key, md5('Unknown')) AS genre_key, gn.genre_category FROM games e
         LEFT JOIN dim_genre gn ON trim(split_part(e.genres_details, ',', 1)) = gn.genre_name""",
)
def text_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key derived from text, with a default member for games without a genre."""
    games = stored_games(spark, sf_dir, "app_id", "genres_details")
    dim = Dim(
        dim_genre(games), "genre_name", "genre_key", csv_element("genres_details", 1), default_key(),
        carry={"genre_category": "genre_category"},
    )
    return star_join(games.select("app_id", "genres_details"), [dim]).drop("genres_details")


@register(
    "N9_sparse_defaults",
    with_ctes("d_rows", "d_tags")
    + """SELECT d.load_id, coalesce(t.best, '') AS best_tag, coalesce(genres, 'Unknown') AS genres FROM d_rows d
         LEFT JOIN (SELECT load_id, min(tag) AS best FROM d_tags GROUP BY load_id) t ON t.load_id = d.load_id""",
)
def sparse_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bronze(spark, sf_dir, "raw_details")
    tags = explode_object(raw, "raw_data", "bigint", "$.tags", ["load_id"], "tag", "votes")
    best = tags.groupBy("load_id").agg(F.min("tag").alias("best"))
    rows = raw.select("load_id", F.expr("raw_data:genre::string").alias("genres"))
    return lookup(rows, best, ["load_id"]).select(
        "load_id",
        F.coalesce("best", F.lit("")).alias("best_tag"),
        F.coalesce("genres", F.lit("Unknown")).alias("genres"),
    )


@register(
    "N10_lateral_flatten",
    with_ctes("d_tags", "d_rows")
    + """SELECT d.load_id, d.name, t.tag FROM d_rows d, LATERAL (SELECT tag FROM d_tags x WHERE x.load_id = d.load_id) t""",
)
def lateral_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL form of the flatten join, on the VARIANT column itself."""
    bronze(spark, sf_dir, "raw_details").createOrReplaceTempView("gs_raw_details")
    return spark.sql(
        """SELECT r.load_id, r.raw_data:name::string AS name, f.key AS tag
           FROM gs_raw_details r, LATERAL variant_explode(r.raw_data:tags) f"""
    )


@register(
    "N11_star_join",
    """SELECT o_orderkey, c_mktsegment, coalesce(n_name, 'nowhere') AS n_name, d.date_key, o_totalprice FROM orders
         LEFT JOIN customer ON c_custkey = o_custkey
         LEFT JOIN nation ON n_nationkey = c_nationkey
         LEFT JOIN (SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key
                    FROM generate_series(DATE '1996-01-01', DATE '2000-12-31', INTERVAL 1 DAY) t(day)) d
           ON d.date_key = CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER)""",
)
def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = star_join(
        orders,
        [
            Dim(
                table(spark, sf_dir, "customer"), "c_custkey", "c_mktsegment", F.col("o_custkey"),
                carry={"c_nationkey": "c_nationkey"},
            ),
            Dim(
                table(spark, sf_dir, "nation"), "n_nationkey", "n_name", F.col("c_nationkey"),
                default=F.lit("nowhere"),
            ),
            # Part of the order days, so that some orders find their day and some do not.
            Dim(dim_date(spark, "1996-01-01", "2000-12-31"), "date_key", "date_key", date_key("o_orderdate")),
        ],
    )
    return out.select("o_orderkey", "c_mktsegment", "n_name", "date_key", "o_totalprice")
