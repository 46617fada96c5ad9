"""Connected components of a link table by alternating large and small stars.

Every round is a min-aggregation and a join on node ids, written to the shared
folder so that lineage stays short.  Nothing is collected but one flag per
round.  A hot node meets the join as one partially aggregated row, and its
links are split by AQE's skew join.  Rounds end as soon as the links are stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gildstar.session import run_folder


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """One star round; ``links`` hold each link once, larger id in ``u``, smaller in ``v``."""
    directed = links if small else links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = directed.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = directed.join(least, "u")
    if small:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    else:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = out.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))


def _are_stars(links: DataFrame) -> bool:
    """Whether each larger end has one link and is no smaller end: then every smaller end is its component's least."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("v", F.lit(0), F.lit(1))
    )
    torn = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1")
    return torn.isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is its smallest node.

    NULL ends and loops are ignored; repeated links count once; no links give no rows.
    """
    spark = links.sparkSession
    folder = run_folder(spark, "components")
    current = (
        links.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    current.write.parquet(f"{folder}/0")
    number = 0
    while True:
        current = spark.read.parquet(f"{folder}/{number}")
        if _are_stars(current):
            break
        number += 1
        _stars(_stars(current, small=False), small=True).distinct().write.parquet(f"{folder}/{number}")
    # Stars keep who is linked to whom, so every node points at the smallest node of its component.
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
