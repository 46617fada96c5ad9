"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (operator 9).

Documents of a source fall by hash into blocks of about ``BLOCK_WORDS`` words.
A source whose target is r times its words gives floor(r) whole passes of its
blocks and, for the rest, blocks in a permuted order until the target is
reached; the last of these is taken up to the word.  The number of blocks each
source owes is split over the output shards by a binary tree: a node deals its
block slots to its two halves by a multivariate hypergeometric draw, source by
source.  A shard then takes the next blocks of each source's permuted sequence
and is shuffled locally, so no step sorts or moves a whole source at one place.

Everything is DataFrame expressions.  All draws come from hashes of a seed and
the names of what is drawn, so reruns and recomputed tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gildstar.llm.common import SPACES
from gildstar.session import run_folder

BLOCK_WORDS = 1 << 14
BLOCKS_PER_SHARD = 256
MOST_COPIES = 3
_UNIT = float(1 << 53)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, sid, source_size, target) from (source, size).

    Weights 1, 2, 3 repeat along the sources by code point, NULL last.  Filling
    up: sources by rising cap per weight; the first whose share of what the
    capped ones leave stays within its cap sets the level for all others.
    These windows see one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_ratio = everything.orderBy("_ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    s = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(by_name))
        .withColumn("_w", ((F.col("sid") - 1) % 3 + 1).cast("double"))
        .withColumn("_cap", (F.col("source_size") * MOST_COPIES).cast("double"))
        .withColumn("_ratio", F.col("_cap") / F.col("_w"))
    )
    s = s.withColumn(
        "_level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(by_ratio), F.lit(0.0)))
        / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(by_ratio), F.lit(0.0))),
    )
    open_ = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "sid", "_level"))
    level = F.min(open_).over(everything)["_level"]
    return s.withColumn("target", F.least(F.col("_cap"), F.coalesce(F.col("_w") * level, F.col("_cap")))).select(
        "source", "sid", "source_size", "target"
    )


def _uniform(*parts) -> str:
    """A number in [0, 1) from a hash of SQL expressions."""
    return f"((xxhash64({', '.join(parts)}) & {(1 << 53) - 1}L) / {_UNIT}D)"


def _draw(seed: int) -> str:
    """SQL for the number of a source's ``q.k`` blocks that go to the left half, given ``acc``.

    ``acc.p`` counts the slots of all sources not yet dealt, ``acc.n`` the free
    slots of the left half.  Hypergeometric by inversion: a walk from the mode
    upwards, then downwards, within twelve standard deviations.
    """
    p, k, n = "cast(acc.p as double)", "cast(q.k as double)", "cast(acc.n as double)"
    mode = f"cast(floor(({n} + 1) * ({k} + 1) / ({p} + 2)) as bigint)"
    spread = f"cast(ceil(12 * sqrt({n} * {k} / {p} * (1 - {k} / {p}) + 1)) + 12 as bigint)"
    low = f"greatest(0L, acc.n - (acc.p - q.k))"
    high = f"least(acc.n, q.k)"
    start = f"least(greatest({mode}, {low}), {high})"
    # Bind the numbers once, then walk over positions 0 .. up + down.
    bound = (
        f"named_struct('m', {start}, 'up', least({high} - {start}, {spread}), "
        f"'down', least({start} - {low}, {spread}), 'p', {p}, 'k', {k}, 'n', {n})"
    )
    x = "(case when i <= b.up then b.m + i else b.m - 1 - (i - b.up - 1) end)"
    # Ratio of the weight at x to the one at x - 1, and at x to the one at x + 1.
    rise = f"((b.k - {x} + 1) * (b.n - {x} + 1) / ({x} * (b.p - b.k - b.n + {x})))"
    fall = f"((({x} + 1) * (b.p - b.k - b.n + {x} + 1)) / ((b.k - {x}) * (b.n - {x})))"
    weight = (
        f"(case when i = 0 then 1D when i <= b.up then s.w * {rise} when i = b.up + 1 then {fall} else s.w * {fall} end)"
    )
    total = (
        f"aggregate(sequence(0L, b.up + b.down), named_struct('w', 0D, 'z', 0D), "
        f"(s, i) -> named_struct('w', {weight}, 'z', s.z + {weight}), s -> s.z)"
    )
    u = _uniform(f"{seed}", "node", "q.sid")
    pick = (
        f"aggregate(sequence(0L, b.up + b.down), named_struct('w', 0D, 'z', 0D, 'x', -1L, 't', {u} * {total}), "
        f"(s, i) -> named_struct('w', {weight}, 'z', s.z + {weight}, "
        f"'x', case when s.x < 0 and s.z + {weight} > s.t then {x} else s.x end, 't', s.t), "
        f"s -> case when s.x < 0 then b.m else s.x end)"
    )
    return f"element_at(transform(array({bound}), b -> {pick}), 1)"


def split_node(nodes: DataFrame, seed: int) -> DataFrame:
    """Halves of the nodes (node, slots, quota array<struct<sid, k>>); children of v are 2v and 2v + 1."""
    dealt = nodes.withColumn("_left", F.expr("slots div 2")).withColumn(
        "_deal",
        F.expr(
            "aggregate(quota, named_struct('p', slots, 'n', _left, 'out', "
            "cast(array() as array<struct<sid:int,k:bigint,l:bigint>>)), "
            f"(acc, q) -> element_at(transform(array({_draw(seed)}), l -> named_struct("
            "'p', acc.p - q.k, 'n', acc.n - l, 'out', array_append(acc.out, "
            "named_struct('sid', q.sid, 'k', q.k, 'l', l)))), 1), acc -> acc.out)"
        ),
    )
    halves = F.array(
        F.struct(
            (F.col("node") * 2).alias("node"),
            F.col("_left").alias("slots"),
            F.expr("transform(_deal, d -> named_struct('sid', d.sid, 'k', d.l))").alias("quota"),
        ),
        F.struct(
            (F.col("node") * 2 + 1).alias("node"),
            (F.col("slots") - F.col("_left")).alias("slots"),
            F.expr("transform(_deal, d -> named_struct('sid', d.sid, 'k', d.k - d.l))").alias("quota"),
        ),
    )
    return dealt.select(F.explode(halves).alias("h")).select(
        "h.node", "h.slots", F.expr("filter(h.quota, q -> q.k > 0)").alias("quota")
    )


class Mix:
    """The plan of a mix: ``rows`` per document, ``blocks`` drawn, each with its shard."""

    def __init__(self, docs: DataFrame, seed: int = 20, doc_id: str = "doc_id", text: str = "text", source: str = "source"):
        spark = docs.sparkSession
        self.folder = run_folder(spark, "mix")
        self.seed, self.spark = seed, spark
        columns = (F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"))
        measured = docs.select(*columns, word_count(text).alias("size"), self._row_hash(doc_id, text).alias("_h"))
        measured.write.parquet(f"{self.folder}/measured")
        measured = spark.read.parquet(f"{self.folder}/measured")
        source_targets(measured).write.parquet(f"{self.folder}/sources")
        self.sources = (
            spark.read.parquet(f"{self.folder}/sources")
            .withColumn("_n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / BLOCK_WORDS)).cast("long"))
            .withColumn("_goal", F.round("target").cast("long"))
            .withColumn("_passes", F.when(F.col("source_size") > 0, F.expr("_goal div source_size")).otherwise(0))
            .withColumn("_rest", F.col("_goal") - F.col("_passes") * F.col("source_size"))
        )
        self.rows = self.in_blocks(measured)
        self._draw_blocks()

    def _row_hash(self, doc_id: str, text: str) -> Column:
        return F.xxhash64(F.lit(self.seed), F.col(doc_id).cast("long"), F.col(text))

    def in_blocks(self, measured: DataFrame) -> DataFrame:
        """Rows with (source, _h) get their source's numbers and their block."""
        named = self.sources.withColumnRenamed("source", "_source")
        return (
            measured.join(named, measured["source"].eqNullSafe(named["_source"]))
            .drop("_source")
            .withColumn("block", F.expr("pmod(_h, _n_blocks)"))
        )

    def _draw_blocks(self) -> None:
        """Write the drawn block instances (sid, block, words, take, shard)."""
        spark, seed = self.spark, self.seed
        sized = (
            self.rows.filter("size > 0")
            .groupBy("sid", "block")
            .agg(F.sum("size").alias("words"), F.first("_passes").alias("_passes"), F.first("_rest").alias("_rest"))
        )
        # Every pass has a permutation of its own; the windows see one row per block.
        order = Window.partitionBy("sid").orderBy("pass", "_p", "block")
        drawn = (
            sized.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("_passes").cast("int"))))
            .withColumn("_p", F.xxhash64(F.lit(seed), "sid", "pass", "block"))
            .withColumn(
                "_before",
                F.coalesce(
                    F.sum("words").over(
                        Window.partitionBy("sid", "pass")
                        .orderBy("_p", "block")
                        .rowsBetween(Window.unboundedPreceding, -1)
                    ),
                    F.lit(0),
                ),
            )
            .withColumn(
                "take",
                F.when(F.col("pass") < F.col("_passes"), F.col("words")).otherwise(
                    F.least("words", F.col("_rest") - F.col("_before"))
                ),
            )
            .filter("take > 0")
            .withColumn("position", F.row_number().over(order).cast("long"))
            .select("sid", "block", "pass", "words", "take", "position")
        )
        drawn.write.parquet(f"{self.folder}/drawn")
        drawn = spark.read.parquet(f"{self.folder}/drawn")
        quotas = drawn.groupBy("sid").agg(F.count(F.lit(1)).alias("k"))
        nodes = (
            quotas.agg(
                F.sum("k").alias("slots"),
                F.array_sort(F.collect_list(F.struct(F.col("sid").cast("int").alias("sid"), "k"))).alias("quota"),
            )  # one entry per source
            .filter("slots > 0")
            .select(F.lit(1).cast("long").alias("node"), "slots", "quota")
        )
        slots = quotas.agg(F.sum("k")).first()[0] or 0
        depth = max(0, (-(-slots // BLOCKS_PER_SHARD) - 1).bit_length())
        for level in range(depth):
            split_node(nodes, seed).write.parquet(f"{self.folder}/level-{level}")
            nodes = spark.read.parquet(f"{self.folder}/level-{level}")
        first = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        owed = (
            nodes.select((F.col("node") - (1 << depth)).alias("shard"), F.explode("quota").alias("q"))
            .select("shard", F.col("q.sid").alias("sid"), F.col("q.k").alias("k"))
            .withColumn("_from", F.coalesce(F.sum("k").over(first), F.lit(0)) + 1)
            .withColumn("position", F.explode(F.expr("sequence(_from, _from + k - 1)")))
            .select("sid", "position", "shard")
        )
        drawn.join(owed, ["sid", "position"]).write.parquet(f"{self.folder}/blocks")
        self.blocks = spark.read.parquet(f"{self.folder}/blocks")

    def _pieces(self, rows: DataFrame) -> DataFrame:
        """(sid, block, _h, doc_id, piece): what the blocks taken in part take of their documents, in hash order."""
        part = self.blocks.filter("take < words").select("sid", "block", "take")
        before = (
            Window.partitionBy("sid", "block")
            .orderBy("_h", "doc_id")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return (
            rows.filter("size > 0")
            .join(part, ["sid", "block"])
            .withColumn("_before", F.coalesce(F.sum("size").over(before), F.lit(0)))
            .withColumn("piece", F.greatest(F.lit(0), F.least(F.col("size"), F.col("take") - F.col("_before"))))
        )

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) for every row.

        NULL texts have size 0; rows without words are never taken.  A NULL
        source is a source of its own, the last.  Repeated rows are rows of
        their own.  An empty table gives no rows.
        """
        whole = self.blocks.filter("take = words").groupBy("sid", "block").agg(F.count(F.lit(1)).alias("_whole"))
        has_part = self.blocks.filter("take < words").select("sid", "block", F.lit(True).alias("_part"))
        rows = self.rows.join(whole, ["sid", "block"], "left").join(has_part, ["sid", "block"], "left")
        columns = ("doc_id", "size", "source_size", "target")
        full = F.coalesce(F.col("_whole"), F.lit(0)) * F.col("size")
        in_part = F.coalesce("_part", F.lit(False)) & (F.col("size") > 0)
        pieces = self._pieces(rows.filter(in_part))
        return (
            rows.filter(~in_part)
            .select(*columns, full.alias("taken"))
            .union(pieces.select(*columns, (full + F.col("piece")).alias("taken")))
        )

    def mixed(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
        """The mixed documents with the columns of ``docs``, shard by shard in shuffled order.

        A document is repeated as often as its blocks are drawn.  Documents are
        not cut: of a block taken in part, those of which at least half is taken
        appear.
        """
        names = docs.columns
        wide = docs.select(
            F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"),
            F.col(doc_id).cast("long").alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            word_count(text).alias("size"),
            self._row_hash(doc_id, text).alias("_h"),
        )
        rows = self.in_blocks(wide).select("_doc", "doc_id", "size", "_h", "sid", "block")
        pieces = (
            self._pieces(self.rows)
            .filter("2 * piece >= size")
            .select("sid", "block", "_h", F.col("doc_id").alias("_id"))
            .distinct()
        )
        drawn = rows.filter("size > 0").join(
            self.blocks.select("sid", "block", "pass", "shard", (F.col("take") < F.col("words")).alias("_part")),
            ["sid", "block"],
        )
        in_piece = (
            drawn.filter("_part")
            .alias("d")
            .join(
                pieces.alias("p"),
                F.expr("d.sid = p.sid and d.block = p.block and d._h = p._h and d.doc_id <=> p._id"),
                "left_semi",
            )
        )
        order = F.xxhash64(F.lit(self.seed), "shard", "pass", "_h")
        return (
            drawn.filter("not _part")
            .union(in_piece)
            .repartition("shard")
            .sortWithinPartitions("shard", order)
            .select("_doc.*")
        )
