"""The registered queries of this package: name -> fn(spark, sf_dir), and SQL where it can express one."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gildstar.llm.common import importable
from gildstar.llm.decontaminate import find_leaks
from gildstar.llm.jaccard_join import jaccard_components
from gildstar.llm.line_runs import drop_repeated_lines
from gildstar.llm.main_text import extract
from gildstar.llm.mixing import Mix
from gildstar.llm.phrases import collocations
from gildstar.llm.ppm import score
from gildstar.llm.quality_classifier import classify
from gildstar.llm.quality_rules import apply_rules
from gildstar.llm.sanitise import Sanitiser
from gildstar.llm.spellings import spelling_groups
from gildstar.llm.token_counts import count_tokens
from gildstar.llm.token_file import read_token_file, write_token_file
from gildstar.session import run_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024
    )


@query("op1_token_file")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = f"{run_folder(spark, 'token-file')}/ids"
    path = public_tokenizers.path("word_bpe_49k.json")
    write_token_file(read(spark, sf_dir, "documents"), target, path, end_id=2)
    return read_token_file(spark, target)


@query("op2_main_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


@query("op6_jaccard_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"), n=3, percent=90)


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(read(spark, sf_dir, "documents"))


@query("op8_sanitise")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Sanitiser(read(spark, sf_dir, "documents")).digest()


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Mix(read(spark, sf_dir, "documents")).taken()


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op5_decontaminate")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op4_ppm")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op11_line_dedup",
    f"""WITH l AS (
          SELECT doc_id, generate_subscripts(ls, 1) AS p, unnest(ls) AS line
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
        k AS (SELECT *, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key
              FROM l),
        f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
              GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> doc_id) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (keeper IS NULL OR keeper = doc_id), ''))
                 AS kept_sha256
        FROM k LEFT JOIN f USING (key) GROUP BY doc_id""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    "op12_collocations",
    f"""WITH p AS (
          SELECT coalesce(lang, 'und') AS lang,
                 unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
          FROM documents),
        t AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM p),
        g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
              FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM t, (SELECT unnest([1, 2, 3, 4]) AS m))),
        c AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(f) AS n FROM c WHERE m = 1 GROUP BY lang),
        a AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM c WHERE m > 1 AND f >= 30),
        k AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:m], ' ') AS y
              FROM (SELECT *, unnest(range(1, m)) AS k FROM a)),
        s AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r,
                     CAST((CAST(2000000 AS HUGEINT) * k.a) // (x.f + y.f) AS BIGINT) AS score
              FROM k JOIN c x ON x.lang = k.lang AND x.phrase = k.x JOIN c y ON y.lang = k.lang AND y.phrase = k.y),
        b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        i AS (SELECT lang, array_to_string(w[s:s + q - 1], ' ') AS phrase, max(a) AS longer
              FROM (SELECT *, unnest(range(1, m - q + 2)) AS s FROM (SELECT *, unnest(range(2, m)) AS q FROM a))
              GROUP BY ALL),
        o AS (SELECT b.* FROM b LEFT JOIN i USING (lang, phrase)
              WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
        JOIN n USING (lang) WHERE rank <= 2000""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


@query("op13_spelling_groups")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(read(spark, sf_dir, "documents"))
