"""Information-theoretic sanitisation of personal data (operator 8).

Protected entities are the personal data that patterns find.  The terms of the
documents that hold an entity are judged by the corpus: the entity's information
content less the pointwise mutual information of term and entity over documents
is what stays uncertain about the entity once the term is known, -log2 of the
share of the term's documents that hold it.  That share is taken at its lower
confidence bound (Wilson), and the bars are bits, so neither depends on the size
of the corpus: a term that meets an entity once never discloses it if it occurs
anywhere else.  The bound is wider for ordinary words than for terms that look
like names (with a capital in at least half of their documents, or with digits),
as any long text holds words that occur nowhere else.

Each term is judged twice: against each entity, and against each kind of entity,
where the number of entities it leaves open adds to the uncertainty, so that the
name of somebody with two addresses is found and the word "phone" is not.  No pair is
left out for being rare.  Terms with at most ``GENERALISE`` bits left are replaced
by a class that says what they were, with at most ``REMOVE`` they are removed,
wherever they stand in a document that holds the entity or kind.  Counts cover
all documents and whole texts.  Entities found in the same documents share their
counts and are judged as one.

Everything is DataFrame expressions.  Places of matches come from matching the
text before a match along with it; patterns are anchored at the last match and
possessive, so time is linear in the text and no recursion grows with it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildstar.session import run_folder

GENERALISE, REMOVE = 2.0, 0.5  # bits of uncertainty left: four candidates, fewer than one and a half
GAIN = 3.0  # bits by which a term must at least make an entity likelier, else the entity is merely common
NAME_Z, WORD_Z = 1.0, 3.0  # standard errors of the lower bound for names and codes, and for ordinary words

_TERM = r"\p{L}[\p{L}\p{N}]{2,}"
_BLOCK = 256  # places that are listed together, so that lists grow by blocks


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: gap and match as two groups, a cheap test of the text, a test of a match ``x.v``."""

    name: str
    pattern: str
    maybe: str
    valid: str


_DIGITS = "regexp_replace(x.v, '[^0-9]', '')"
_LUHN = (
    f"aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s + case "
    f"when i % 2 = 1 then cast(substring({_DIGITS}, -i, 1) as int) "
    f"when cast(substring({_DIGITS}, -i, 1) as int) < 5 then 2 * cast(substring({_DIGITS}, -i, 1) as int) "
    f"else 2 * cast(substring({_DIGITS}, -i, 1) as int) - 9 end) % 10 = 0"
)
# A match that starts inside a run of its first character class can only follow the match before it directly:
# if the run as a whole does not match, no later part of it does.
KINDS = (
    Kind(
        "email",
        r"\G(|.*?(?<![A-Za-z0-9._%+-]))([A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)",
        "contains(t, '@')",
        "true",
    ),
    Kind(
        "ip",
        r"\G(|.*?(?<![0-9]))([0-9]++\.[0-9]++\.[0-9]++\.[0-9]++)",
        r"t rlike '[0-9][.][0-9]'",
        "forall(split(x.v, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(p as int), 0) <= 255)",
    ),
    Kind(
        "card",
        r"\G(.*?)([0-9](?:[\x20-]?[0-9])++)",
        "t rlike '[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]'",
        f"length({_DIGITS}) between 12 and 19 and {_LUHN}",
    ),
    Kind(
        "phone",
        r"\G(.*?)(\+[0-9][\x20().0-9-]+[0-9])",
        "contains(t, '+')",
        f"length({_DIGITS}) between 9 and 15",
    ),
)


def _place_blocks(text: str, pattern: str) -> str:
    """SQL: array of blocks of (s, e, v), the matches of group 2 in ``text`` by code points."""
    quoted = "r'(?s)" + pattern + "'"
    empty = "cast(array() as array<struct<s:int,e:int,v:string>>)"
    matches = (
        f"zip_with(regexp_extract_all({text}, {quoted}, 1), regexp_extract_all({text}, {quoted}, 2), "
        "(g, m) -> named_struct('g', length(g), 'm', m))"
    )
    block = (
        f"aggregate(b, named_struct('p', a.p, 'out', {empty}), "
        "(c, x) -> named_struct('p', c.p + x.g + length(x.m), 'out', array_append(c.out, "
        "named_struct('s', c.p + x.g, 'e', c.p + x.g + length(x.m), 'v', x.m))))"
    )
    return (
        f"transform(array({matches}), w -> aggregate("
        f"transform(sequence(0, (size(w) - 1) div {_BLOCK}), i -> slice(w, cast(i * {_BLOCK} + 1 as int), {_BLOCK})), "
        "named_struct('p', 0, 'out', cast(array() as array<array<struct<s:int,e:int,v:string>>>)), "
        f"(a, b) -> transform(array({block}), r -> named_struct('p', r.p, 'out', array_append(a.out, r.out)))[0], "
        "a -> a.out))[0]"
    )


def _places(text: str, pattern: str) -> str:
    """SQL: array of (s, e, v), the matches of group 2 in ``text`` by code points."""
    return f"flatten({_place_blocks(text, pattern)})"


def base_spans(kind: Kind) -> Column:
    """The valid matches of a kind in column ``t`` as (s, e, v)."""
    return F.expr(
        f"case when {kind.maybe} then filter({_places('t', kind.pattern)}, x -> {kind.valid}) "
        "else cast(array() as array<struct<s:int,e:int,v:string>>) end"
    )


def _terms() -> str:
    """SQL: the terms of ``t`` clear of the entities ``base``, as (term, s, e)."""
    term = rf"\G(|.*?(?<![\p{{L}}\p{{N}}]))({_TERM})"
    around = "filter(base, z -> z.s < element_at(b, -1).e and b[0].s < z.e)"
    clear = f"transform(array({around}), k -> filter(b, y -> not exists(k, z -> z.s < y.e and y.s < z.e)))[0]"
    return (
        f"transform(flatten(transform(filter({_place_blocks('t', term)}, b -> size(b) > 0), b -> {clear})), "
        "y -> named_struct('term', lower(y.v), 's', y.s, 'e', y.e))"
    )


def _distinct_terms(text: str) -> str:
    """SQL: the distinct terms of a text, inside entities too."""
    return rf"array_distinct(transform(regexp_extract_all({text}, r'(?<![\p{{L}}\p{{N}}]){_TERM}', 0), x -> lower(x)))"


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h, n_<kind>.., base, places, words) per row: spans (k, s, e, v), and of rows with some the terms and their places."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t"))
    for kind in KINDS:
        rows = rows.withColumn(f"_{kind.name}", base_spans(kind))
    base = F.concat(
        *[
            F.expr(f"transform(_{kind.name}, x -> named_struct('s', x.s, 'r', {rank}, 'k', '{kind.name}', 'e', x.e, 'v', x.v))")
            for rank, kind in enumerate(KINDS)
        ]
    )
    return (
        rows.withColumn("base", F.array_sort(base))
        .withColumn("places", F.when(F.size("base") > 0, F.expr(_terms())))
        .withColumn("words", F.when(F.size("base") > 0, F.expr(_distinct_terms("t"))))
        .select(
            "doc_id", "h", *[F.size(f"_{k.name}").cast("long").alias(f"n_{k.name}") for k in KINDS], "base", "places", "words"
        )
    )


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, df, cased): in how many rows each term occurs, and in how many of them with a capital."""
    raw = rf"regexp_extract_all(t, r'(?<![\p{{L}}\p{{N}}]){_TERM}', 0)"
    cased = "array_distinct(transform(filter(w, x -> x <> lower(x)), x -> lower(x)))"
    other = "array_except(filter(w, x -> x = lower(x)), c)"
    found = (
        f"transform(array(array_distinct({raw})), w -> transform(array({cased}), c -> concat("
        f"transform(c, x -> named_struct('term', x, 'cased', 1L)), transform({other}, x -> named_struct('term', x, 'cased', 0L))"
        "))[0])[0]"
    )
    rows = docs.select(F.coalesce(text, F.lit("")).alias("t"))
    terms = rows.select(F.explode(F.expr(found)).alias("x")).select("x.*")
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("cased").alias("cased"))


def lower_share(both: Column, df: Column, z: Column) -> Column:
    """The lower end of Wilson's interval for ``both`` of ``df``."""
    p, part = both / df, z * z / df
    return (p + part / 2 - z * F.sqrt(p * (1 - p) / df + part / (4 * df))) / (1 + part)


def judged(meetings: DataFrame, frequencies: DataFrame, total: int) -> DataFrame:
    """``meetings`` (term, both, held, values, ..) with ``class`` and ``uncertainty``, as far as terms disclose something.

    ``both`` of the term's rows hold the entity, or one of ``values`` entities,
    that ``held`` of all ``total`` rows hold.
    """
    code, name = F.col("term").rlike(r"\p{N}"), 2 * F.col("cased") >= F.col("df")
    share = lower_share(F.col("both"), F.col("df"), F.when(code | name, NAME_Z).otherwise(WORD_Z))
    return (
        meetings.join(frequencies, "term")
        .withColumn("class", F.when(code, "CODE").when(name, "NAME").otherwise("TERM"))
        .withColumn("_share", share)
        .withColumn("uncertainty", F.log2("values") - F.log2("_share"))
        .filter((F.col("uncertainty") <= GENERALISE) & (F.log2(F.col("_share") * total / F.col("held")) >= GAIN))
        .drop("_share", "cased")
    )


class Sanitiser:
    """Entities of all documents and the terms that disclose them."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text"):
        spark = docs.sparkSession
        folder = run_folder(spark, "sanitise")
        find(docs, doc_id, text).write.parquet(f"{folder}/found")
        self.found = spark.read.parquet(f"{folder}/found")
        held = self.found.filter(F.size("base") > 0)
        texts = held.groupBy("h").agg(
            F.count(F.lit(1)).alias("copies"), F.any_value("base").alias("base"), F.any_value("words").alias("words")
        )
        texts.write.parquet(f"{folder}/texts")  # each distinct text with entities once
        texts = spark.read.parquet(f"{folder}/texts")
        entities = texts.select(
            "h", "copies", F.explode(F.expr("array_distinct(transform(base, x -> concat(x.k, ':', lower(x.v))))")).alias("entity")
        )
        classes = entities.groupBy("entity").agg(
            F.sum("copies").alias("entity_df"),
            F.count(F.lit(1)).alias("n_texts"),
            F.bit_xor("h").alias("x1"),
            F.bit_xor(F.xxhash64("h", F.lit(7))).alias("x2"),
        )
        self.of_class = ["entity_df", "n_texts", "x1", "x2"]
        of_text = entities.join(classes, "entity").groupBy("h", *self.of_class).agg(F.max("copies").alias("copies"))
        self.pairs = of_text.join(texts.select("h", F.explode("words").alias("term")), "h")
        meet = self.pairs.groupBy(*self.of_class, "term").agg(F.sum("copies").alias("both"))
        meet.withColumnRenamed("entity_df", "held").withColumn("values", F.lit(1)).write.parquet(f"{folder}/meetings")
        meet = spark.read.parquet(f"{folder}/meetings")
        document_frequencies(docs, text).join(meet.select("term").distinct(), "term").write.parquet(f"{folder}/frequencies")
        frequencies = spark.read.parquet(f"{folder}/frequencies")
        total = max(1, self.found.count())
        disclosing = judged(meet, frequencies, total).withColumnRenamed("held", "entity_df")
        disclosing.write.parquet(f"{folder}/disclosing")
        self.disclosing = spark.read.parquet(f"{folder}/disclosing")

        kinds = F.expr("array_distinct(transform(base, x -> x.k))")
        self.kinds = texts.select("h", "copies", "words", F.explode(kinds).alias("kind"))
        held = self.kinds.groupBy("kind").agg(F.sum("copies").alias("held"))
        rows = self.kinds.select("kind", "copies", F.explode("words").alias("term"))
        rows = rows.groupBy("kind", "term").agg(F.sum("copies").alias("both"))
        of_kind = F.expr("array_distinct(transform(base, x -> named_struct('kind', x.k, 'entity', lower(x.v))))")
        values = (
            texts.select(F.explode(of_kind).alias("x"), "words")
            .select("x.*", F.explode("words").alias("term"))
            .distinct()
            .groupBy("kind", "term")
            .agg(F.count(F.lit(1)).alias("values"))
        )
        meet = rows.join(values, ["kind", "term"]).join(F.broadcast(held), "kind")  # a row per kind
        judged(meet, frequencies, total).write.parquet(f"{folder}/disclosing_kinds")
        self.disclosing_kinds = spark.read.parquet(f"{folder}/disclosing_kinds")

    def spans(self) -> DataFrame:
        """``found`` with ``terms``: the disclosing terms of the row as (s, r, k, e, v).

        k is 'generalise' or 'remove', v the class of the term: NAME, CODE or TERM.
        """
        told = ["h", "term", "class", "uncertainty"]
        by_value = self.pairs.join(self.disclosing, [*self.of_class, "term"]).select(*told)
        by_kind = self.kinds.select("h", "kind", F.explode("words").alias("term")).join(
            self.disclosing_kinds, ["kind", "term"]
        )
        of_text = by_value.union(by_kind.select(*told)).groupBy("h", "term", "class").agg(F.min("uncertainty").alias("left"))
        places = self.found.filter(F.size("places") > 0).select("doc_id", "h", "places").dropDuplicates(["doc_id", "h"])
        of_row = (
            places.select("doc_id", "h", F.explode("places").alias("x"))
            .select("doc_id", "h", "x.*")
            .join(of_text, ["h", "term"])
            .groupBy(F.col("doc_id").alias("_id"), F.col("h").alias("_h"))
            .agg(
                F.collect_list(
                    F.struct(
                        "s",
                        F.lit(len(KINDS)).alias("r"),
                        F.when(F.col("left") <= REMOVE, "remove").otherwise("generalise").alias("k"),
                        "e",
                        F.col("class").alias("v"),
                    )
                ).alias("terms")
            )  # one document's terms
        )
        joined = self.found.join(
            of_row, self.found["doc_id"].eqNullSafe(of_row["_id"]) & (self.found["h"] == of_row["_h"]), "left"
        )
        return joined.drop("_id", "_h")

    def digest(self, doc_id: str = "doc_id") -> DataFrame:
        """(doc_id, n_<kind>.., base_sha256, spans) for every row.

        NULL texts count as empty: no spans, and the hash of the empty text.
        NULL ids stay NULL.  Repeated rows are returned and counted repeatedly.
        An empty table gives no rows.
        """
        listed = "array_join(transform({0}, x -> concat(x.k, ':', x.s, ':', x.e)), ',')"
        both = "array_sort(concat(base, coalesce(terms, filter(base, x -> false))))"
        return self.spans().select(
            F.col("doc_id").alias(doc_id),
            *[f"n_{k.name}" for k in KINDS],
            F.sha2(F.expr(listed.format("base")), 256).alias("base_sha256"),
            F.expr(listed.format(both)).alias("spans"),
        )

    def sanitised(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """(doc_id, text) with entities and generalised terms replaced by their class and the others removed."""
        spans = self.spans().select(
            F.col("doc_id").alias("_id"),
            F.col("h").alias("_h"),
            F.expr("array_sort(concat(base, coalesce(terms, filter(base, x -> false))))").alias("_all"),
        ).distinct()
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("t"))
        rows = rows.withColumn("h", F.xxhash64("t"))
        joined = rows.join(spans, rows["doc_id"].eqNullSafe(spans["_id"]) & (rows["h"] == spans["_h"]))
        # Spans may overlap: what is already behind is not written again.
        built = (
            "aggregate(_all, named_struct('p', 0, 'out', ''), (a, x) -> case when x.e <= a.p then a else named_struct("
            "'p', x.e, 'out', concat(a.out, substring(t, a.p + 1, greatest(0, x.s - a.p)), case x.k when 'remove' then '' "
            "when 'generalise' then concat('[', x.v, ']') else concat('[', upper(x.k), ']') end)) end, "
            "a -> concat(a.out, substring(t, a.p + 1)))"
        )
        return joined.select(F.col("doc_id").alias(doc_id), F.expr(built).alias(text))
