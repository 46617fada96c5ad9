"""Exact Jaccard join of word n-gram sets by PartEnum signatures (operator 6).

Sets are put into size bands so narrow that two sets with the wanted similarity
lie in the same or in neighbouring bands; each set is signed for its own band
and the next.  Within a band the similarity bounds the Hamming distance by k.
The shingle domain is cut by hash into n1 parts, each into three cells.  n1 is
so large that two sets within k differ by at most k2 shingles in at least
1 + ``slack`` of the parts; there they agree on some 3 - k2 cells.  Signatures
are the hashes of all sets of 3 - k2 cells of a part, so no link is missed.
Signatures of empty cells, which unlike sets share, are left out unless a set
has more than ``slack`` parts with one (then another shared part is not sure to
be filled).  Similar sets share so many signatures of a band that a set with
fewer shared ones is left out of it before sets are compared.

Equal sets form a class first.  Links are then searched between classes only,
and only as far as components need them: each class is verified against the
class it shares most signatures with, components are built, twice.  What still
shares a signature across two components is compared through pivots: the
smallest class of a signature is the pivot of its classes, each of which is kept
as its symmetric difference d to the pivot.  The Hamming distance of x and y is
|dx| + |dy| - 2 |dx & dy|; with S(x) = (100 + percent) |dx| - (100 - percent) |x|
they are similar exactly if S(x) + S(y) <= 2 (100 + percent) |dx & dy|.  Classes
with S(x) + S(m) <= 0 link to the class m of least S; any other pair must share
so many members of their differences that the rarest of these meet.  Large groups
of near copies therefore cost about one verification per class instead of one
per pair, unlike copies meet nobody, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gildstar.llm.common import encode_words, giving_back, large_texts, mix64, slices, split_words
from gildstar.llm.components import components
from gildstar.session import run_folder, shed_shuffles
from gildstar.sources import versions

CELLS = 3
DIFFERING = 1  # k2: by how many shingles two sets may differ in a part that they share
_SUBSETS = [list(c) for c in combinations(range(CELLS), CELLS - DIFFERING)]
CROWDS = 1 << 18
# Text bytes cut into shingles or signed at one time: either takes several times as much as the text behind it.
SIGN_BYTES = 2 << 20
# Signatures are sorted in so many shares of a usual partition: there are up to two per shingle, each some 100 bytes in a sort.
SIGN_SHARES = 4
_ODD = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The distinct n-word shingles of each text as sorted 64-bit hashes."""
    words, per_text = split_words(pc.ascii_lower(texts))
    codes, distinct = encode_words(words)
    hashes = np.array(
        [xxhash.xxh64_intdigest(w) for w in distinct.cast(pa.large_binary()).to_pylist()] or [0], np.uint64
    )
    w = hashes[codes] if len(codes) else np.zeros(0, np.uint64)
    rolled = np.zeros(max(0, len(w) - n + 1), np.uint64)
    for i in range(n):
        rolled = mix64(rolled * _ODD[0] + w[i : i + len(rolled)] * _ODD[1] + np.uint64(i + 1))
    sets = []
    ends = np.cumsum(per_text)
    for end, count in zip(ends.tolist(), per_text.tolist()):
        if count >= n:
            sets.append(np.unique(rolled[end - count : end - n + 1]))
        elif count:
            whole = np.array([count], np.uint64)
            for i in range(end - count, end):
                whole = mix64(whole * _ODD[2] + w[i : i + 1] * _ODD[3])
            sets.append(whole)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_keys(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set as signed integers."""
    keys = []
    for odd in (_ODD[0], _ODD[2]):
        sums = np.array([int(mix64(s + odd).sum(dtype=np.uint64)) ^ len(s) for s in sets], np.uint64)
        keys.append(mix64(sums + odd).view(np.int64))
    return keys[0], keys[1]


def size_bands(percent: int, limit: int = 1 << 31) -> np.ndarray:
    """Lower ends of the size bands: a band reaches from l to floor(100 l / percent)."""
    lower = [1]
    while lower[-1] < limit:
        lower.append(lower[-1] * 100 // percent + 1)
    return np.array(lower, np.int64)


def _cut(sets: list[np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For the own band of each set, then the next: band and slack per set, owner and number per part, use and cell per member, empty pairs of cells per part."""
    bands = size_bands(percent)
    sizes = np.array([len(s) for s in sets], np.int64)
    mine = np.searchsorted(bands, sizes, side="right") - 1
    everything = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    part_bits, cell_bits = everything >> np.uint64(32), everything & np.uint64(0xFFFFFFFF)
    of = np.repeat(np.arange(len(sets)), sizes)
    for step in (0, 1):
        band = mine + step
        upper = bands[np.clip(band + 1, 0, len(bands) - 1)] - 1
        k = 2 * upper * (100 - percent) // (100 + percent)
        slack = 1 + k // 10  # more than the parts with empty cells that a set of this band is likely to have
        n1 = np.where((k > 0) & (sizes > 0), k // (DIFFERING + 1) + 1 + slack, 0)
        first = np.cumsum(n1) - n1
        use = n1[of] > 0
        parts = np.where(use, n1[of], 1).astype(np.uint64)
        cell = (first[of] + (part_bits % parts).astype(np.int64)) * CELLS + (
            cell_bits % np.uint64(CELLS)
        ).astype(np.int64)
        total = int(n1.sum()) * CELLS
        if not total:
            continue
        counts = np.bincount(cell[use], minlength=total).reshape(-1, CELLS)
        owner = np.repeat(np.arange(len(sets)), n1)
        part = np.arange(len(owner)) - first[owner]
        empty = np.stack([counts[:, c].sum(1) == 0 for c in _SUBSETS], 1)
        yield band, slack, owner, part, use, cell, empty


def signatures(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the set, signature) for all signatures of all sets; the last bit is that of the band's number."""
    owners, signs = [], []
    value = mix64(np.concatenate(sets) if sets else np.zeros(0, np.uint64))
    low = (value & np.uint64(0xFFFFFFFF)).astype(np.float64)
    high = (value >> np.uint64(32)).astype(np.float64)
    for band, slack, owner, part, use, cell, empty in _cut(sets, percent):
        # Sums of 32-bit halves are exact in doubles up to two million members a cell.
        total = len(owner) * CELLS
        lows = np.bincount(cell[use], low[use], total).astype(np.uint64).reshape(-1, CELLS)
        highs = np.bincount(cell[use], high[use], total).astype(np.uint64).reshape(-1, CELLS)
        many_empty = np.bincount(owner, empty.any(1), len(sets)) > slack
        number_of = band[owner].astype(np.uint64)
        tag = mix64(number_of * _ODD[2] + part.astype(np.uint64))
        for number, cells in enumerate(_SUBSETS):
            sign = mix64(
                lows[:, cells].sum(1, dtype=np.uint64) * _ODD[0]
                + mix64(highs[:, cells].sum(1, dtype=np.uint64) * _ODD[1] + tag)
                + np.uint64(number)
            )
            sign = sign & ~np.uint64(1) | number_of & np.uint64(1)
            kept = ~empty[:, number] | many_empty[owner]
            owners.append(owner[kept])
            signs.append(sign[kept].view(np.int64))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(signs)


def least_shared(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Per set, for its bands of even and of odd number: how many signatures of the band any similar set of it shares at least.

    Two similar sets agree on a pair of cells in 1 + ``slack`` parts.  Without a
    signature are only pairs that are empty in both, and only if neither set has
    more than ``slack`` parts with one; such parts are counted off.
    """
    least = np.ones((len(sets), 2), np.int64)
    for band, slack, owner, _, _, _, empty in _cut(sets, percent):
        gaps = np.bincount(owner, empty.any(1), len(sets)).astype(np.int64)
        least[np.arange(len(sets)), band & 1] = np.where(gaps > slack, 1, 1 + slack - gaps)
    return least


def keyed_sets(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2) per row of (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())])

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SIGN_BYTES):
            sets = shingle_sets(large_texts(part.column("text")), n)
            k1, k2 = set_keys(sets)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), sizes, pa.array(k1), pa.array(k2)], schema=schema
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long")


def signed_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(sign, k1) of all sets; equal sets of a slice are signed once."""
    schema = pa.schema([("sign", pa.int64()), ("k1", pa.int64())])

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SIGN_BYTES):
            seen: set[tuple[int, int]] = set()
            sets = shingle_sets(large_texts(part.column("text")), n)
            k1, k2 = set_keys(sets)
            new = []
            for i, key in enumerate(zip(k1.tolist(), k2.tolist())):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            owner, sign = signatures([sets[i] for i in new], percent)
            order = np.argsort(owner, kind="stable")  # equal keys stand together and compress well in the shuffle
            yield pa.RecordBatch.from_arrays(
                [pa.array(sign[order]), pa.array(k1[np.array(new, np.int64)][owner[order]])], schema=schema
            )

    return docs.filter("doc_id is not null").mapInArrow(run, "sign long, k1 long")


def shared_signatures(signed: DataFrame) -> DataFrame:
    """(sign, k1), each once, of the signatures (sign, k1) that unlike sets share.

    One shuffle of all signatures is the operator's largest; a join with counted
    ones would need two.  A task sorts its shares one after the other, so an
    executor holds a part of what it sorts, and writes one file.
    """
    parts = int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = Window.partitionBy("sign")
    return (
        signed.repartition(SIGN_SHARES * parts, "sign")
        .withColumn("_lo", F.min("k1").over(whole))
        .withColumn("_hi", F.max("k1").over(whole))
        .filter("_lo < _hi")
        .select("sign", "k1")
        .distinct()
        .coalesce(parts)
    )


def packed_sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, shingles, bands) of the rows (doc_id, text, k1, k2, even, odd) whose text has the key (k1, k2) and may be similar to another.

    ``even`` and ``odd`` count the shared signatures of the set's band of even and
    of odd number, ``bands`` are those (0, 1) in which they are enough.
    """
    lists = {"shingles": pa.list_(pa.int64()), "bands": pa.list_(pa.int32())}
    schema = pa.schema([("doc_id", pa.int64()), *lists.items()])

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SIGN_BYTES):
            sets = shingle_sets(large_texts(part.column("text")), n)
            same = np.logical_and(*(part.column(c).to_numpy() == k for c, k in zip(("k1", "k2"), set_keys(sets))))
            enough = np.stack([part.column(c).to_numpy() for c in ("even", "odd")], 1) >= least_shared(sets, percent)
            kept = np.flatnonzero(same & enough.any(1))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(kept)),
                    pa.array([sets[i].view(np.int64) for i in kept], lists["shingles"]),
                    pa.array([np.flatnonzero(enough[i]).astype(np.int32) for i in kept], lists["bands"]),
                ],
                schema=schema,
            )

    return docs.mapInArrow(run, "doc_id long, shingles array<long>, bands array<int>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) for the class pairs (a, b), by the exact set comparison."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", (both * 100 >= percent * (F.size("sa") + F.size("sb") - both)).alias("linked"))
    )


def _best_partner(rows: DataFrame) -> DataFrame:
    """(a, b): for each node the smallest node of another component it shares most signatures with.

    ``rows`` are (sign, node, component).  Per signature only the smallest node
    is a partner, so the number of pairs stays below the number of signatures.
    """
    first = rows.groupBy("sign").agg(F.min(F.struct("component", "node")).alias("_first"))
    shared = (
        rows.join(first, "sign")
        .filter("component <> _first.component")
        .groupBy(F.col("node").alias("a"), F.col("_first.node").alias("b"))
        .count()
    )
    best = shared.groupBy("a").agg(F.max_by("b", F.struct("count", -F.col("b"))).alias("b"))
    return best.select("a", "b")


def _cross(marked: DataFrame) -> DataFrame:
    """Rows (sign, node, component) of the signatures that span two components.

    Counted by partial aggregation, so a signature that many classes share is
    one row per task, and its rows join one row.
    """
    ends = marked.groupBy("sign").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"))
    return marked.join(ends.filter("_lo < _hi").select("sign"), "sign").select("sign", "node", "component")


def _crowding(sets: DataFrame) -> np.ndarray:
    """How many set members fall into each of ``CROWDS`` hash buckets: a table of fixed size."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(CROWDS, np.int64)
        for batch in batches:
            members = batch.column("shingles").flatten().to_numpy(zero_copy_only=False)
            table += np.bincount(members & (CROWDS - 1), minlength=CROWDS)
        used = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(table[used])], schema=schema)

    counted = sets.select("shingles").mapInArrow(count, "bucket int, n long")
    summed = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(CROWDS, np.int64)
    table[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return table


def _differences(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(pivot, node, s, shingles): each class as its difference to the pivots of its signatures, with its S."""
    pivots = rows.groupBy("sign").agg(F.min("node").alias("pivot"))
    pairs = rows.select("sign", "node").join(pivots, "sign").select("node", "pivot").distinct()
    own = sets.select(F.col("doc_id").alias("node"), F.col("shingles").alias("sx"))
    other = sets.select(F.col("doc_id").alias("pivot"), F.col("shingles").alias("sp"))
    apart = F.concat(F.array_except("sx", "sp"), F.array_except("sp", "sx"))
    rest = 100 - percent
    return (
        pairs.join(own, "node")
        .join(other, "pivot")
        .withColumn("shingles", apart)
        .select(
            "pivot",
            "node",
            ((100 + percent) * F.size("shingles") - rest * F.size("sx")).cast("long").alias("s"),
            "shingles",
        )
    )


def _apart(differences: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """The classes that must be compared: (pivot, node, component, s, far, asks).

    With ``m`` the least S of a group, a class is far if S + m > 0; groups without
    far classes, within one component or of one class besides the pivot, which m
    settles, are left out.  ``asks`` is the least
    number of common members with which a comparison can succeed.  y's difference
    has members enough for x only if T(y) = 2 (100 + percent) |dy| - S(y) is S(x)
    or more, so the least S of such partners tells; it is kept per step of T, a
    table of some two hundred steps at most.
    """
    twice = 2 * (100 + percent)
    slim = (
        differences.join(component, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("step", F.expr(f"cast(8 * log2({twice} * size(shingles) - s + 1) as int)"))
        .select("pivot", "node", "component", "s", "step", (F.size("shingles") > 0).cast("int").alias("other"))
    )
    stepped = slim.groupBy("pivot", "step").agg(
        F.min("s").alias("least"),
        F.max("s").alias("most"),
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
        F.sum("other").alias("others"),
    )
    groups = (
        stepped.groupBy("pivot")
        .agg(
            F.min("least").alias("m"),
            F.max("most").alias("most"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.sum("others").alias("others"),
            F.collect_list(F.struct("step", "least")).alias("steps"),
        )
        .filter("lo < hi and most + m > 0 and others > 1")
        .select("pivot", "m", "steps")
    )
    partners = "filter(steps, t -> s <= 0 or t.step >= cast(8 * log2(s + 1) as int))"
    return (
        slim.join(groups, "pivot")
        .withColumn("far", F.expr("s + m > 0"))
        .withColumn("_least", F.expr(f"array_min(transform({partners}, t -> t.least))"))
        .withColumn("asks", F.expr(f"greatest(1, cast(ceil((s + _least) / {float(twice)}) as int))"))
        .select("pivot", "node", "component", "s", "far", "asks")
    )


def _prefixes(differences: DataFrame, apart: DataFrame) -> DataFrame:
    """(meets, node, component, s, far, room): the rarest members of each difference.

    Two differences with c members in common, sorted in any one order, first meet
    in a member that c - 1 others or more follow in both; ``room`` counts a member
    and those that follow.  Rarest first by the crowding of all differences, what
    a pivot alone has or lacks comes last.  ``meets`` is a hash of pivot and member.
    """
    shared = apart.sparkSession.sparkContext.broadcast(_crowding(differences))
    kinds = {"meets": pa.int64(), "node": pa.int64(), "component": pa.int64(), "s": pa.int64(), "far": pa.bool_()}
    schema = pa.schema([*kinds.items(), ("room", pa.int32())])

    @giving_back
    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowding = shared.value
        for batch in batches:
            lists = batch.column("shingles")
            members = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            order = np.lexsort((members, crowding[members & (CROWDS - 1)], row))
            room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(members))
            kept = np.flatnonzero(room >= batch.column("asks").to_numpy()[row])
            of, chosen = pa.array(row[kept]), members[order[kept]].view(np.uint64)
            pivots = batch.column("pivot").to_numpy().view(np.uint64)[row[kept]]
            meets = mix64(chosen + mix64(pivots) * _ODD[1]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(meets),
                    *(batch.column(c).take(of) for c in ("node", "component", "s", "far")),
                    pa.array(room[kept].astype(np.int32)),
                ],
                schema=schema,
            )

    rows = differences.select("pivot", "node", "shingles").join(apart, ["pivot", "node"]).filter("asks <= size(shingles)")
    return rows.mapInArrow(rarest, "meets long, node long, component long, s long, far boolean, room int")


def _prefix_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """(a, b): nodes of different components, one of them far, that meet with room for enough common members."""
    x, y = prefixes.alias("x"), prefixes.alias("y")
    enough = F.expr(f"{2 * (100 + percent)} * least(x.room, y.room) >= x.s + y.s")
    wanted = (F.col("x.meets") == F.col("y.meets")) & (F.col("x.node") < F.col("y.node"))
    wanted = wanted & (F.col("x.component") != F.col("y.component")) & (F.col("x.far") | F.col("y.far")) & enough
    return x.join(y, wanted).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def jaccard_components(
    docs: DataFrame, n: int, percent: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    Two rows link when their distinct n-word shingles (A-Z in lower case, words
    cut at ASCII white space) have a Jaccard similarity of ``percent`` or more.
    Texts with fewer words have their whole word sequence as one shingle; NULL
    texts and texts without words have an empty set and link with nothing.  Rows
    with a NULL id link with nothing and have a NULL component.  Repeated rows
    are returned repeatedly.  Rows that share an id but not a text are compared
    like others.  Shingles are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    folder = run_folder(spark, "jaccard")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    with shed_shuffles(spark):
        keyed_sets(docs, n).write.parquet(f"{folder}/keys")
        keys = spark.read.parquet(f"{folder}/keys")
        classes = (
            keys.filter("n_shingles > 0 and doc_id is not null")
            .groupBy("k1", "k2")
            .agg(F.min("doc_id").alias("node"))
        )
        classes.write.parquet(f"{folder}/classes")
        classes = spark.read.parquet(f"{folder}/classes")

        shared_signatures(signed_sets(docs, n, percent)).write.parquet(f"{folder}/shared")
        shared = spark.read.parquet(f"{folder}/shared")
        odd = F.col("sign").bitwiseAND(F.lit(1))
        held = shared.groupBy("k1").agg(F.sum(1 - odd).alias("even"), F.sum(odd).alias("odd"))
        wanted = held.join(classes, "k1").select(F.col("node").alias("doc_id"), "k1", "k2", "even", "odd")
        packed_sets(docs.join(wanted, "doc_id"), n, percent).write.parquet(f"{folder}/sets")
        sets = spark.read.parquet(f"{folder}/sets")
        bands = sets.select(F.col("doc_id").alias("_node"), F.explode("bands").alias("_band"))
        (
            shared.join(classes, "k1")
            .join(bands, (F.col("node") == F.col("_node")) & (odd == F.col("_band")), "left_semi")
            .select("sign", "node")
            .write.parquet(f"{folder}/nodes")
        )
        nodes = spark.read.parquet(f"{folder}/nodes")

        marked = nodes.withColumn("component", F.col("node"))
        of_node = None

        def merged(found: DataFrame, number: int) -> DataFrame:
            """The component of every linked node: the stars so far with the links found since."""
            every = found
            if of_node is not None:
                stars = of_node.filter("node <> component")
                every = found.union(stars.select(F.col("node").alias("a"), F.col("component").alias("b")))
            components(every).write.parquet(f"{folder}/components-{number}")
            return spark.read.parquet(f"{folder}/components-{number}").select("node", "component")

        for number in range(2):
            pairs = _best_partner(_cross(marked))
            _linked(pairs, sets, percent).filter("linked").select("a", "b").write.parquet(f"{folder}/links-{number}")
            of_node = merged(spark.read.parquet(f"{folder}/links-{number}"), number)
            marked = nodes.join(of_node, "node", "left").select(
                "sign", "node", F.coalesce("component", "node").alias("component")
            )

        _differences(_cross(marked), sets, percent).write.parquet(f"{folder}/differences")
        differences = spark.read.parquet(f"{folder}/differences")
        least = differences.groupBy("pivot").agg(F.min(F.struct("s", "node")).alias("m"))
        near = differences.drop("shingles").join(least, "pivot").filter("s + m.s <= 0 and node <> m.node")
        near.select(F.col("node").alias("a"), F.col("m.node").alias("b")).distinct().write.parquet(f"{folder}/links-2")
        of_node = merged(spark.read.parquet(f"{folder}/links-2"), 2)

        _apart(differences, of_node, percent).write.parquet(f"{folder}/apart")
        _prefixes(differences, spark.read.parquet(f"{folder}/apart")).write.parquet(f"{folder}/prefixes")
        versions.delete(spark, f"{folder}/differences")
        pairs = _prefix_pairs(spark.read.parquet(f"{folder}/prefixes"), percent)
        _linked(pairs, sets, percent).filter("linked").select("a", "b").write.parquet(f"{folder}/links-3")
        of_node = merged(spark.read.parquet(f"{folder}/links-3"), 3)

    # Copies of one text meet here as one class row; AQE splits a hot class.
    of_class = classes.join(of_node, "node", "left").select(
        "k1", "k2", F.coalesce("component", "node").alias("class_component")
    )
    return keys.join(of_class, ["k1", "k2"], "left").select(
        F.col("doc_id").alias(doc_id),
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id")).alias("component_id"),
    )
