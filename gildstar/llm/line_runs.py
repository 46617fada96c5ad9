"""Repeated lines against levelled sorted runs of line hashes (operator 11, native).

A *run* is a table (h1, h2, docs, keeper) of distinct line hashes, bucketed and
sorted by hash: how many documents hold the line, and the largest id of them.
Each batch of documents reduces its lines to such rows, drops by merge anti-join
those that a run already knows to be frequent with a larger keeper, and adds the
rest as a run of level 0.  ``fanout`` runs of one level are merged into one of
the next, so that few runs are open at any time and a row is rewritten once per
level.  As runs and batch share the buckets, a merge reads the runs in place.

Which runs are live is a version (``sources.versions``): a driver lost while it
adds or compacts leaves the runs as they were, and a store can be opened again
by any later session.

Everything is DataFrame expressions.  A line that a third of the documents hold
is one partially aggregated row per task in the counts, and its occurrences join
one row, which AQE's skew join splits.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.session import run_folder
from gildstar.sources import versions

MIN_CHARS = 40
MIN_DOCS = 5
FANOUT = 4
# Batches that one call over a whole table deals its documents into.
BATCHES = 4

_RUN = "h1 BIGINT, h2 BIGINT, docs BIGINT, keeper BIGINT"
_STRIPPED = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased and nothing else.

    ``translate`` looks at every character on its own, so it is left to lines
    that are neither ASCII nor free of upper case.
    """
    bare = F.btrim(line, F.lit(_STRIPPED))
    lowered = F.lower(bare)
    return (
        F.when(F.octet_length(bare) == F.char_length(bare), lowered)
        .when(lowered == bare, bare)
        .otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))
    )


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _row_key(doc_id: str, text: str) -> list[Column]:
    """What tells rows apart: id and a 128-bit hash of the text; equal rows agree."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.col(doc_id).cast("long").alias("id"), F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(11), whole).alias("t2")]


def line_postings(docs: DataFrame, min_chars: int = MIN_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, t1, t2, pos, h1, h2): every line of at least ``min_chars`` code points, by a 128-bit hash of its key."""
    lines = docs.select(*_row_key(doc_id, text), F.posexplode(_lines(F.col(text))).alias("pos", "line"))
    long_ones = lines.filter(F.char_length(F.btrim("line", F.lit(_STRIPPED))) >= min_chars)
    keyed = long_ones.withColumn("key", line_key(F.col("line")))
    return keyed.select("id", "t1", "t2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(13), "key").alias("h2"))


def summarise(postings: DataFrame) -> DataFrame:
    """(h1, h2, docs, keeper) of a batch: documents are distinct ids, all rows without an id are one document."""
    once = postings.select("h1", "h2", "id").distinct()
    return once.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keeper"))


class LineRuns:
    """The live runs under ``folder``; batches added must not share documents.

    Opening a folder that holds runs goes on with them.  ``buckets`` is fixed by
    the first batch (default: the session's shuffle partitions).
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        min_docs: int = MIN_DOCS,
        fanout: int = FANOUT,
        buckets: int | None = None,
    ):
        self.spark, self.folder, self.min_docs, self.fanout = spark, folder.rstrip("/"), min_docs, fanout
        number, state = versions.current(spark, self.folder)
        self.buckets = state["buckets"] if state else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(self) -> list[dict]:
        """Live runs: level and folder name, oldest first."""
        return (versions.current(self.spark, self.folder)[1] or {"runs": []})["runs"]

    def table(self, run: dict) -> DataFrame:
        """A run as a bucketed table, registered in this session when it is first read."""
        name = f"gildstar_{run['name']}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_RUN}) USING parquet "
            f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.folder}/{run['name']}'"
        )
        return self.spark.table(name)

    def _write(self, rows: DataFrame, level: int) -> dict:
        """Write rows that are dealt by ``repartition(buckets, h1, h2)`` as one sorted file per bucket."""
        run = {"level": level, "name": f"run_{uuid.uuid4().hex}"}
        (
            rows.select("h1", "h2", "docs", "keeper")
            .write.format("parquet")
            .bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .option("path", f"{self.folder}/{run['name']}")
            .saveAsTable(f"gildstar_{run['name']}")
        )
        return run

    def _commit(self, number: int, runs: list[dict]) -> None:
        versions.commit(self.spark, self.folder, number, {"buckets": self.buckets, "runs": runs})

    def add(self, postings: DataFrame) -> None:
        """Add one batch: a merge anti-join with every run, one new run, and compaction where a level is full.

        A line that some run has seen in ``min_docs`` documents, with a keeper
        that this batch does not exceed, is decided: it need not be counted on.
        """
        number, state = versions.current(self.spark, self.folder)
        live = state["runs"] if state else []
        fresh = summarise(postings)
        for run in live:
            known = self.table(run).filter(F.col("docs") >= self.min_docs).select("h1", "h2", F.col("keeper").alias("k"))
            fresh = fresh.join(
                known.hint("merge"),
                (fresh["h1"] == known["h1"]) & (fresh["h2"] == known["h2"]) & (known["k"] >= fresh["keeper"]),
                "left_anti",
            )
        self._commit(number, [*live, self._write(fresh.repartition(self.buckets, "h1", "h2"), 0)])
        self._compact()

    def _compact(self) -> None:
        while True:
            number, state = versions.current(self.spark, self.folder)
            levels: dict[int, list[dict]] = {}
            for run in state["runs"]:
                levels.setdefault(run["level"], []).append(run)
            full = next((level for level, runs in sorted(levels.items()) if len(runs) >= self.fanout), None)
            if full is None:
                return
            merged = self._write(self._merged(levels[full]), full + 1)
            left = [r for r in state["runs"] if r["level"] != full]
            self._commit(number, [*left, merged])
            for run in levels[full]:
                self.spark.sql(f"DROP TABLE IF EXISTS gildstar_{run['name']}")
                versions.delete(self.spark, f"{self.folder}/{run['name']}")

    def _merged(self, runs: list[dict]) -> DataFrame:
        """The sum of some runs, dealt by bucket.

        The files are read as plain Parquet: Spark 4.1 takes a union of bucketed
        scans for dealt by bucket, but reads it file by file, and would sum each
        run alone.
        """
        whole = self.spark.read.schema(_RUN).parquet(*[f"{self.folder}/{r['name']}" for r in runs])
        dealt = whole.repartition(self.buckets, "h1", "h2")
        return dealt.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))

    def frequent(self) -> DataFrame:
        """(h1, h2, keeper) of the lines that at least ``min_docs`` documents hold."""
        live = self.runs()
        if not live:
            return self.spark.createDataFrame([], "h1 bigint, h2 bigint, keeper bigint")
        return self._merged(live).filter(F.col("docs") >= self.min_docs).select("h1", "h2", "keeper")

    def close(self) -> None:
        """Forget the session's table names; the files stay."""
        for run in self.runs():
            self.spark.sql(f"DROP TABLE IF EXISTS gildstar_{run['name']}")


def _batch_of(docs: DataFrame, batches: int, doc_id: str) -> Column:
    """The batch of an id, largest ids first, rows without an id in the last; equal ids share a batch."""
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.select(F.percentile_approx(F.col(doc_id).cast("long"), shares, 10_000)).first()[0] if shares else None
    number = sum((F.col("id") <= c).cast("int") for c in sorted(set(cuts or [])))
    return F.coalesce(F.lit(0) + number, F.lit(batches - 1)) if cuts else F.lit(0)


def drop_repeated_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): every row of ``docs`` without its repeated lines.

    A line is repeated if at least ``min_docs`` documents hold its key; it then
    stays only in the document of the largest id, wherever it stands there.

    A NULL or empty text is one empty line.  Documents are told apart by id: rows
    that repeat an id count as one document and keep or lose a line together; all
    rows without an id are one document, below every id.  Repeated rows come out
    as often as they come in; an empty table gives no rows.  Only ``doc_id`` and
    ``text`` are read, so other columns cannot clash.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "line-runs")
    postings = line_postings(docs, min_chars, doc_id, text).withColumn("batch", _batch_of(docs, batches, doc_id))
    postings.write.partitionBy("batch").parquet(f"{folder}/postings")
    schema = "id bigint, t1 bigint, t2 bigint, pos int, h1 bigint, h2 bigint, batch int"
    postings = spark.read.schema(schema).parquet(f"{folder}/postings")

    runs = LineRuns(spark, f"{folder}/runs", min_docs, fanout)
    for batch in range(batches):
        runs.add(postings.filter(F.col("batch") == batch))
    runs.frequent().write.parquet(f"{folder}/frequent")
    runs.close()
    frequent = spark.read.schema("h1 bigint, h2 bigint, keeper bigint").parquet(f"{folder}/frequent")

    dropped = (
        postings.join(frequent, ["h1", "h2"])
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id", "t1", "t2")
        .agg(F.collect_set("pos").alias("gone"))
        .select(F.col("id").alias("_id"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "gone")
    )
    rows = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"), *_row_key(doc_id, text))
    joined = rows.join(
        dropped,
        rows["id"].eqNullSafe(dropped["_id"]) & (rows["t1"] == dropped["_t1"]) & (rows["t2"] == dropped["_t2"]),
        "left",
    ).select(F.col("_doc").alias("doc_id"), F.coalesce("_text", F.lit("")).alias("whole"), "gone")
    # The text is split once: a lambda variable holds its lines while positions pick from them.
    left = (
        "element_at(transform(array(split(whole, '\\n')), "
        "ls -> transform(array_except(sequence(0, size(ls) - 1), gone), i -> ls[i])), 1)"
    )
    return joined.select(
        F.col("doc_id").alias(doc_id),
        (F.regexp_count("whole", F.lit("\n")) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("whole"))
        .otherwise(F.array_join(F.expr(left), "\n"))
        .alias("kept"),
    )
