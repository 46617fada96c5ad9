"""Landing raw rows with a place for bad payloads, once per ingestion (A1).

Payloads are parsed once.  One job writes good rows and rejected ones to a
hidden folder beside the bronze files; moving its files is all that publishing
takes.  A landing has an id: landing it again, after a lost driver or by
mistake, moves what has not been moved yet, or does nothing.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildstar.functions.keys import date_key
from gildstar.session import file_system
from gildstar.sources import versions

# Columns that bronze files hold beside the raw table's: both NULL in every row that landed.
REJECT_COLUMNS = ("_payload", "_reason")
_OUTCOME, _LANDED, _REJECTED = "_outcome", "landed", "rejected"
# The largest text a VARIANT takes.
MOST_BYTES = 128 << 20


@dataclass(frozen=True)
class Landing:
    """What a landing left behind; ``repeated`` if it had been completed before."""

    landed: int
    rejected: int
    repeated: bool


def _reason(payload: Column, parsed: Column) -> Column:
    """Why a payload cannot land, NULL if it can; an absent payload lands as NULL."""
    return F.when(
        payload.isNotNull() & parsed.isNull(),
        F.when(F.trim(payload) == "", "empty text")
        .when(F.octet_length(payload) > MOST_BYTES, "too large")
        .otherwise("malformed JSON"),
    )


def _marker(path: str, landing: str) -> str:
    return f"{path.rstrip('/')}/_landings/{landing}.json"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def _move_all(spark: SparkSession, source: str, target: str) -> None:
    """Move the files below ``source`` to the same places below ``target``; what has moved before is not there any more."""
    fs, p = file_system(spark, source)
    if not fs.exists(p):
        return
    files = fs.listFiles(p, True)
    root = fs.makeQualified(p).toString().rstrip("/")
    while files.hasNext():
        at = files.next().getPath()
        name = at.getName()
        if name.startswith(("_", ".")):
            continue
        goal = file_system(spark, f"{target}/{at.toString()[len(root) + 1 :]}")[1]
        fs.mkdirs(goal.getParent())
        if not fs.rename(at, goal):
            raise OSError(f"cannot move {at.toString()} to {goal.toString()}")


def land_checked(
    df: DataFrame, path: str, rejects: str, landing: str, payload: str = "raw_data", day_of: str | None = None
) -> Landing:
    """Add the rows of one ingestion to the raw table at ``path``, and those that do not parse to ``rejects``.

    ``landing`` names the ingestion; a completed one is not landed again, and one
    that was interrupted goes on from where it stopped.  ``day_of`` is as in
    ``land_bronze``.  Payloads that are VARIANT already cannot be bad.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", landing):
        raise ValueError(f"a landing id is letters, digits, dots, dashes and underscores, got {landing!r}")
    spark, root = df.sparkSession, path.rstrip("/")
    marker, stage = _marker(root, landing), f"{root}/_staged-{landing}"
    if _exists(spark, marker):
        done = json.loads(versions.read_text(spark, marker))
        return Landing(done["landed"], done["rejected"], True)

    counts = f"{stage}/_counts.json"
    if not _exists(spark, counts):
        versions.delete(spark, stage)
        is_text = not isinstance(df.schema[payload].dataType, T.VariantType)
        parsed = F.try_parse_json(payload) if is_text else F.col(payload)
        checked = df.withColumn("_parsed", parsed)
        reason = _reason(F.col(payload), F.col("_parsed")) if is_text else F.lit(None).cast("string")
        text = F.col(payload) if is_text else F.lit(None).cast("string")
        checked = checked.withColumn("_reason", reason)
        rows = checked.select(
            *[F.col("_parsed").alias(c) if c == payload else F.col(c) for c in df.columns],
            F.when(F.col("_reason").isNotNull(), text).alias("_payload"),
            "_reason",
            F.when(F.col("_reason").isNull(), _LANDED).otherwise(_REJECTED).alias(_OUTCOME),
            *([date_key(day_of).alias(f"{day_of}_day")] if day_of else []),
        )
        rows.write.partitionBy(_OUTCOME, *([f"{day_of}_day"] if day_of else [])).parquet(stage)
        found = {r[_OUTCOME]: r["count"] for r in spark.read.schema(f"{_OUTCOME} string").parquet(stage).groupBy(_OUTCOME).count().collect()}
        totals = {"landed": found.get(_LANDED, 0), "rejected": found.get(_REJECTED, 0)}
        versions.create_text(spark, counts, json.dumps(totals))
    totals = json.loads(versions.read_text(spark, counts))
    _move_all(spark, f"{stage}/{_OUTCOME}={_REJECTED}", f"{rejects.rstrip('/')}/landing={landing}")
    _move_all(spark, f"{stage}/{_OUTCOME}={_LANDED}", root)
    versions.create_text(spark, marker, json.dumps(totals))
    versions.delete(spark, stage)
    return Landing(totals["landed"], totals["rejected"], False)


def read_rejects(spark: SparkSession, rejects: str, envelope: str) -> DataFrame:
    """Rejected rows: the ``envelope`` columns (a schema without the payload), payload text, reason and landing."""
    schema = f"{envelope}, _payload string, _reason string, landing string"
    fs, p = file_system(spark, rejects)
    if not fs.exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(rejects)
