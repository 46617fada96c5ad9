"""The training-data pipeline over ``documents``: five stages, each written as Parquet and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.llm.common import importable
from gildstar.llm.decontaminate import mark_leaks
from gildstar.llm.jaccard_join import jaccard_components
from gildstar.llm.mixing import Mix
from gildstar.llm.quality_classifier import classify
from gildstar.llm.token_file import read_token_file, write_token_file
from gildstar.session import run_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Near duplicates: five-word shingles, Jaccard similarity of 80 percent or more.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
END_ID = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text_key(docs: DataFrame) -> Column:
    """A 128-bit hash of the text as a string; NULL counts as empty."""
    return F.md5(F.coalesce(docs["text"], F.lit("")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts, decided for each row.

    Rows go by id and text: a rejected row takes no other text of its id along,
    and rows without an id are judged like others.  NULL and empty texts are
    scored from zero features; repeated rows stay or go together; an empty table
    gives no rows; other columns are handed on.
    """
    importable(spark)
    scored = classify(
        docs.select("doc_id", "text", _text_key(docs).alias("key")), _table(spark, sf_dir, "labels"), key="key"
    )
    rejected = scored.filter("predicted = 0").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    same = docs["doc_id"].eqNullSafe(rejected["_id"]) & (_text_key(docs) == rejected["_key"])
    return docs.join(rejected, same, "left_anti")


# Above this stand the ids that rows without one are compared under, so that rows with an id are kept before them.
_WITHOUT_ID = 1 << 62


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows with a NULL id are compared too, under an id made of their text: one of
    a group stays if no row with an id is in it.  Rows without words are in no
    group and stay; rows that repeat an id stay or go together; an empty table
    gives no rows; other columns are handed on.
    """
    importable(spark)
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    named, nameless = docs.filter("doc_id is not null"), docs.filter("doc_id is null")
    texts = nameless.filter(words).dropDuplicates(["text"])
    made = F.lit(_WITHOUT_ID) + F.xxhash64("text").bitwiseAND(F.lit(_WITHOUT_ID - 1))
    compared = named.select("doc_id", "text").unionByName(texts.select(made.alias("doc_id"), "text"))
    grouped = jaccard_components(compared, SHINGLE_WORDS, SIMILAR_PERCENT)
    doubles = grouped.filter("doc_id <> component_id").select(F.col("doc_id").alias("_id")).distinct()
    folder = f"{run_folder(spark, 'pipeline-doubles')}/ids"
    doubles.write.parquet(folder)
    doubles = spark.read.parquet(folder)
    kept = named.join(doubles, named["doc_id"] == doubles["_id"], "left_anti")
    single = texts.join(doubles, made == doubles["_id"], "left_anti")
    return kept.unionByName(single).unionByName(nameless.filter(~F.coalesce(words, F.lit(False))))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    NULL and empty texts contain none; every row is decided by its own text, so
    NULL and repeated ids make no difference; an empty table gives no rows.
    """
    importable(spark)
    marked = mark_leaks(docs, _table(spark, sf_dir, "benchmark"), column="_leaks")
    return marked.filter(F.size("_leaks") == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources at weights 1, 2, 3; documents of scarce sources repeat."""
    importable(spark)
    return Mix(docs).mixed(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per row, from the token file written for all rows."""
    importable(spark)
    target = f"{run_folder(spark, 'pipeline-tokens')}/ids"
    write_token_file(docs, target, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return read_token_file(spark, target)


STAGES: list[tuple[str, Stage]] = [
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

# The stages learn, join by similarity and encode; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what its predecessor kept."""
    docs = _table(spark, sf_dir, "documents")
    folder = run_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
