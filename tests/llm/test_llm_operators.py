"""Each operator on small edge fixtures against brute force; every registered query on the smallest tables."""

from __future__ import annotations

import collections
import hashlib
import html
import itertools
import math
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gildstar.llm import decontaminate, jaccard_join, mixing, ppm, quality_classifier, quality_rules, rans, sanitise
from gildstar.llm.common import importable, split_words
from gildstar.llm.components import components
from gildstar.llm.jaccard_join import jaccard_components, signatures
from gildstar.llm.main_text import extract, main_text
from gildstar.llm.queries import QUERIES
from gildstar.llm.token_counts import count_tokens
from gildstar.llm.token_file import read_token_file, write_token_file
from gildstar.session import run_folder

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, source string, size long, h long, block string, n_tokens string, leaks string"

EDGE_TEXTS = [
    None,
    "",
    " ",
    "a  b",
    "a   b \n c",
    " lead",
    "trail ",
    "The the THE the the the the the the the the the the",
    "x<|endoftext|> y  <|endoftext|>",
    "it's we'LL don't",
    "É à ß µ² 日本語 テスト。 1234",
    "tab\tsep\r\nline\x0bv\x0cf",
    "no break　wide",
    "word " * 3000,
    "y" * 5000,
]


@pytest.fixture(scope="module")
def edge(spark):
    """Edge texts, a NULL id, a repeated row, a repeated id with another text; columns that clash with results."""
    importable(spark)
    rows = [(i, t, f"s{i % 2}") for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "null id here", None), (3, "a  b", "s1"), (4, "other text", "s0")]
    return spark.createDataFrame([(i, t, s, 7, 7, "b", "n", "l") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark, edge):
    return edge.filter(F.lit(False))


def by_row(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))


def source_rows(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


def test_token_counts_match_the_library(edge, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    expected = []
    for i, t in source_rows(edge):
        n = len(library.encode(t, add_special_tokens=False).ids)
        expected.append((i, len(t.encode()), n, n > 5))
    for head in (0, 3, 1 << 18):
        assert by_row(count_tokens(edge, path, 5, head=head)) == sorted(
            expected, key=lambda t: tuple((v is not None, str(v)) for v in t)
        )
    assert count_tokens(empty, path, 5).count() == 0


def test_token_counts_tell_texts_of_one_id_apart(spark):
    importable(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    by_crc = {}
    pair = None
    for i in itertools.count():
        text = f"note {i * 7919} " + "x" * (i % 9)
        other = by_crc.setdefault(zlib.crc32(text.encode()), text)
        if other != text and len(other) != len(text):
            pair = [other, text]
            break
    docs = spark.createDataFrame([(None, t) for t in [*pair, pair[0]]] + [(4, t) for t in pair], "doc_id long, text string")
    wanted = [(None, t) for t in [*pair, pair[0]]] + [(4, t) for t in pair]
    got = collections.Counter(tuple(r) for r in count_tokens(docs, path, 5).collect())
    sizes = {t: len(library.encode(t, add_special_tokens=False).ids) for t in pair}
    assert got == collections.Counter((i, len(t.encode()), sizes[t], sizes[t] > 5) for i, t in wanted)


def test_token_file_round_trip(spark, edge, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    expected = collections.Counter()
    for i, t in source_rows(edge):
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4")
        expected[(i, len(ids), zlib.crc32(ids.tobytes()))] += 1
    target = f"{run_folder(spark, 'test')}/ids"
    write_token_file(edge, target, path, 2)
    got = read_token_file(spark, target).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == np.cumsum([0] + [r["n_tokens"] for r in ordered])[:-1].tolist()
    ids = [r["doc_id"] for r in ordered]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    target = f"{run_folder(spark, 'test')}/none"
    write_token_file(empty, target, path, 2)
    assert read_token_file(spark, target).count() == 0


@pytest.mark.parametrize("sizes", [[1], [5, 1, 70000], [40000, 33, 32, 31]])
def test_rans_round_trip_and_damage(sizes):
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, sum(sizes)), 49407).astype(np.uint32)
    frame = rans.encode(ids, sizes)
    assert (rans.decode(frame) == ids).all()
    assert bool(frame.checkpoints) == (max(sizes) > rans.LANES * rans.CHECKPOINT_STEPS)
    frame.blocks[0] = (*frame.blocks[0][:2], frame.blocks[0][2] ^ 1)
    with pytest.raises(ValueError):
        rans.decode(frame)


def test_main_text_of_pages(spark):
    importable(spark)
    prose = "The cat is on the mat and it was not for us to say that this is the end of it, as they have with you at the house."
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Home</a></ul></nav>"
        f"<div class='cookie-notice'>We use cookies. {prose}</div>"
        f"<article class=post><header><h1>Head &amp; tail</h1></header><p>{prose}<p>Of.<br>Two\n  spaces</p>"
        "<ul><li>one<li>two</ul><script>var a='<p>no</p>'</script><p hidden>never</p>"
        f"<div class='ad'>{prose}</div><p>Nät &#233;</p></article>"
        f"<section id=comments><p>{prose}</p></section><aside>{prose}</aside><footer>{prose}</footer></body>"
    )
    wanted = f"Head & tail\n{prose}\nOf. Two spaces\none\ntwo\nNät é"
    assert main_text(page) == wanted
    cut = page[: page.index("Nät") + 2]
    assert main_text(cut).endswith("Nä")
    plain = f"<body><div><a href=a>Menu</a> <a href=b>More</a></div><p>{prose}</p><p>Short.</p><p>{prose}</p></body>"
    assert main_text(plain) == f"{prose}\nShort.\n{prose}"
    pages = spark.createDataFrame(
        [(1, "u", page, "x"), (2, None, None, "x"), (None, "v", "", "x"), (1, "u", page, "x")],
        "page_id long, url string, html string, text string",
    )
    assert by_row(extract(pages)) == by_row(
        spark.createDataFrame(
            [(1, "u", wanted, len(wanted)), (1, "u", wanted, len(wanted)), (2, None, "", 0), (None, "v", "", 0)],
            "a long, b string, c string, d long",
        )
    )
    assert extract(pages.filter(F.lit(False))).count() == 0


def test_main_text_inside_and_outside_articles():
    prose = "The cat is on the mat and it was not for us to say that this is the end of it, as they have with you at the house."
    advert = "Buy cheap shoes now! Best prices, free shipping, great brands, huge discounts. " * 3
    links = "".join(f"<li><a href=/{i}>Another story {i}</a></li>" for i in range(5))
    line = " ".join(f"<a href=/{i}>Ten ways to see the world for less {i}</a>" for i in range(5))
    page = (
        f"<article><h1><a href=/>Head</a></h1><p>{prose}</p><p>Short.</p><ul><li>one<li>two</ul><p>{prose}</p>"
        f"<p>{advert}</p><h3>More</h3><ul>{links}</ul><p>{line}</p><p><a href=t>Tweet</a> <a href=s>Share</a></p></article>"
    )
    assert main_text(page) == f"Head\n{prose}\nShort.\none\ntwo\n{prose}"
    teaser = f"<div><p>{prose}</p><p>{prose}</p><p>Short.</p></div><article><h2>Next</h2><p>Soon here.</p></article>"
    assert main_text(teaser).startswith(f"{prose}\n{prose}\nShort.")
    # In a language without listed stop words, and where nothing is long, the article stays.
    other = "Kissa istuu matolla, koska ulkona sataa vettä. " * 4
    assert main_text(f"<article><p>{other}</p><p>Loppu.</p></article>") == f"{other.strip()}\nLoppu."
    assert main_text(f"<article><p>Short.</p><ul>{links}</ul></article>") == "Short."


def test_main_text_keeps_what_an_article_has_besides_prose():
    prose = "The cat is on the mat and it was not for us to say that this is the end of it, as they have with you at the house."
    numbers = " ".join(f"{i * 37}.{i % 10}" for i in range(60))
    code = "for (int i=0;i<n;i++) { x[i] = y[i] * 2; } return x.f(0); " * 5
    names = "Zorblax Quimby, Ada Byron, Grace Hopper, Alan Turing, Kurt Gödel, Emmy Noether. " * 4
    marked = " ".join(f"{w}{m}" for w, m in zip(prose.split() * 2, ["&&&", "|", "***", "$$$"] * 13))
    rare = "Cats sleep until morning comes again, then they run outside, chase small birds, climb tall trees, drink cold water, nap. "
    kept = [prose, numbers, code, names, marked, rare + rare[:40], prose]
    page = "<article>" + "".join(f"<p>{html.escape(p)}</p>" for p in kept) + "</article>"
    assert main_text(page) == "\n".join(" ".join(p.split()) for p in kept)
    # An apostrophe or a quote opens a value only after an equals sign.
    for attribute in ("title=it's", "title='it\"s'", 'x" y', 'title = "a>b"', "title=a'b=c"):
        assert main_text(f"<article><p {attribute}>Don't go. {prose}</p><p>It's \"here\".</p></article>") == (
            f"Don't go. {prose}\nIt's \"here\"."
        )
    assert main_text(f"<p title={'a=' * 20000}>{prose}</p>") == prose


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test tables are not here")
def test_main_text_loses_no_word_of_an_article():
    table = pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["html"])
    for page in filter(None, table["html"].to_pylist()):
        inside = re.search(r"<article[^>]*>(.*?)(?:</article>|$)", page, re.S)
        if inside:
            plain = re.sub(r"<(script|style)\b.*?</\1>|<[^>]*>", " ", inside[1], flags=re.S)
            assert main_text(page).split() == html.unescape(plain).split()


def brute_components(texts, n, percent):
    sets = {}
    for i, t in texts:
        w = WORD.findall(t.translate(LOWER))
        sets[i] = set(zip(*[w[k:] for k in range(n)])) if len(w) >= n else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), find(i)) for i in sets)


def varied_texts(count, changes, seed=4):
    rng = random.Random(seed)
    base = [rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(120)]
    out = []
    for i in range(count):
        words = list(base) if i % 3 else [f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 40))]
        for _ in range(rng.randrange(changes)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        out.append((i, " ".join(words).upper() if i % 2 else " ".join(words)))
    return out


@pytest.mark.parametrize("n, percent, changes", [(3, 90, 5), (5, 80, 6), (2, 50, 30)])
def test_jaccard_components_match_brute_force(spark, n, percent, changes):
    importable(spark)
    texts = varied_texts(90, changes) + [(200, ""), (201, "one"), (202, "ONE"), (203, "  ")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard_components(df, n, percent).collect())
    assert got == brute_components(texts, n, percent)


def test_unlike_copies_of_one_text_are_not_compared_pair_by_pair(spark, monkeypatch):
    """Copies with edits of their own share signatures, but too few shingles to link among each other."""
    pick = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(1, 1200):
        words = list(base)
        for j in range(9):
            words[pick.randrange(300)] = f"edit{i}x{j}"
        rows.append((i, " ".join(words)))
    rows += [(5000 + i, " ".join([*base[:250], *[f"tail{k}" for k in range(12)]])) for i in range(3)]
    importable(spark)
    compared = []
    whole = jaccard_join._linked

    def counting(pairs, sets, percent):
        compared.append(pairs.count())
        return whole(pairs, sets, percent)

    monkeypatch.setattr(jaccard_join, "_linked", counting)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(df, 3, 90).collect()}
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, t in rows}
    leader = {i: i for i in sets}

    def find(x):
        while leader[x] != x:
            leader[x] = leader[leader[x]]
            x = leader[x]
        return x

    order = sorted(sets)
    for n, a in enumerate(order):
        for b in order[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both * 100 >= 90 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                leader[y] = x
    assert got == {i: find(i) for i in order}
    assert sum(compared) < 4 * len(rows)


def test_jaccard_edges(edge, empty):
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(edge, 3, 90).collect())
    assert got[(3, 1, 3)] == 2 and got[(None, 1, None)] == 1 and got[(0, 0, 0)] == 1 and sum(got.values()) == edge.count()
    assert jaccard_components(empty, 3, 90).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for percent in (95, 90, 85, 80, 60):
        for size in (5, 20, 21, 150, 1000):
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            same = math.ceil(2 * percent * size / (100 + percent))
            b = np.unique(np.concatenate([a[:same], rng.integers(0, 2**63, size - same, dtype=np.uint64)]))
            owner, sign = signatures([a, b], percent)
            assert len(a) == len(b) == same or set(sign[owner == 0]) & set(sign[owner == 1])


def test_components_of_chain_and_star(spark, rows):
    links = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 140)] + [(5, 5), (None, 3), (7, 6)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_decontamination_recall_and_clean_texts(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(2, 9))) for _ in range(4000)]

    def prose(k):
        return " ".join(rng.choice(vocabulary) for _ in range(k))

    items = [prose(35) for _ in range(40)]

    def edited(t, rate):
        out = list(t)
        for _ in range(int(rate * len(out))):
            at = rng.randrange(len(out))
            out[at : at + rng.randrange(2)] = rng.choice(["", "z", "q"])
        return "".join(out)

    for rate, least in ((0.0, 1.0), (0.05, 0.95), (0.1, 0.9)):
        docs = [(i, f"{prose(50)} {edited(t, rate).upper()}!! {prose(50)}") for i, t in enumerate(items)]
        got = decontaminate.find_leaks(
            spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(list(enumerate(items)), "item_id long, text string"),
        ).collect()
        assert all(r["doc_id"] == r["item_id"] for r in got)
        assert len(got) >= least * len(items)
    clean = spark.createDataFrame([(i, prose(300)) for i in range(50)], "doc_id long, text string")
    assert decontaminate.find_leaks(clean, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).count() == 0


@pytest.mark.parametrize("low, high, least", [(12, 39, 1.0), (40, 63, 1.0), (81, 120, 0.9), (200, 250, 0.9)])
@pytest.mark.parametrize("evenly", [False, True])
def test_decontamination_recall_by_length(low, high, least, evenly):
    rng = random.Random(low)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(2, 9))) for _ in range(4000)]

    def prose(chars):
        t = ""
        while len(t) < chars:
            t = f"{t} {rng.choice(vocabulary)}".strip()
        return t[:chars].strip()

    def edited(t, edits):
        out = list(t)
        for j in range(edits):
            at = int((j + 0.5) * len(out) / edits) if evenly else rng.randrange(len(out))
            kind = 0 if evenly else rng.randrange(3)
            out[at : at + (kind != 1)] = ["z", "zy", ""][kind] if kind != 1 else ["z"]
        return "".join(out)

    items = [prose(rng.randint(low, high)) for _ in range(60)]
    block = decontaminate.Items(list(range(60)), items)
    texts = [f"{prose(90)} {edited(t, len(t) // 5)} {prose(90)}" for t in items]
    got = decontaminate.leaks_of(pa.array(texts, pa.large_string()), block)
    assert sum(any(n == i for n, _ in found) for i, found in enumerate(got)) >= least * len(items)


def test_best_distance_matches_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        item = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 90)))
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
            row = new
        assert decontaminate.best_distance(item, text, len(item)) == min(row)


def test_decontamination_edges(spark, edge, empty):
    edge, empty = edge.drop("leaks"), empty.drop("leaks")
    items = spark.createDataFrame([(1, "null id here"), (1, "null id here"), (2, None), (3, " ")], "item_id long, text string")
    assert by_row(decontaminate.find_leaks(edge, items)) == [(None, 1, 0, 12)] * 2
    assert decontaminate.mark_leaks(edge, items.limit(0)).filter(F.size("leaks") > 0).count() == 0
    assert decontaminate.find_leaks(empty, items).count() == 0


def brute_ppm(texts, train, order):
    tables = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    for t, used in zip(texts, train):
        if used:
            a = b"\xff" * order + t + b"\xff"
            for p in range(order, len(a)):
                for k in range(order + 1):
                    tables[k][a[p - k : p]][a[p]] += 1

    def prob(context, s):
        out, p = set(), 1.0
        for k in range(order, -1, -1):
            f = tables[k].get(context[order - k :] if k else b"")
            if not f:
                continue
            rest = {q: n for q, n in f.items() if q not in out}
            if s in rest:
                return p * (rest[s] - 0.5) / sum(rest.values())
            if rest:
                p *= 0.5 * len(rest) / sum(rest.values())
            out |= set(f)
        return p / (256 - len(out))

    scores = []
    for t in texts:
        a = b"\xff" * order + t + b"\xff"
        scores.append(sum(math.log10(prob(a[p - order : p], a[p])) for p in range(order, len(a))))
    return scores


def test_ppm_matches_brute_force(spark, edge, empty):
    got = [tuple(r) for r in ppm.score(edge, 7, 2).collect()]
    texts = source_rows(edge)
    low = [t.translate(LOWER) for _, t in texts]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in texts]
    counts = collections.Counter()
    for t, h in zip(low, held):
        if not h:
            counts.update([*WORD.findall(t), None])
    total, distinct = sum(counts.values()), len(counts)
    scores = brute_ppm([t.encode() for t in low], [not h for h in held], ppm.ORDER)
    expected = []
    for (i, _), t, h, s in zip(texts, low, held, scores):
        tokens = [*WORD.findall(t), None]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        expected.append((i, h, len(tokens), sum(counts[w] > 0 for w in tokens), total, base, s))
    key = lambda r: (r[0] is not None, str(r[0]), r[2], round(r[6], 2))
    for a, b in zip(sorted(got, key=key), sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-6)
    assert ppm.score(empty).count() == 0
    untrained = ppm.score(edge, 1, 0).agg(F.max("train_tokens"), F.max("n_known")).first()
    assert tuple(untrained) == (0, 0)


def brute_rules(t):
    w = WORD.findall(t)
    seen, repeated = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    marked = {k + j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(5)}
    symbols = len(re.findall(r"[#*$%&|<>]", t))
    return len(w), sum(map(len, w)), symbols, repeated, len(marked), len(w) < 10 or 100 * len(marked) > 20 * len(w)


def test_quality_rules_match_brute_force(spark, edge, empty):
    good = "It was a day of wind and rain, and nobody went out to look at the river or the hills beyond it."
    bad = ["THIS IS ALL LOUD AND LOUDER STILL UNTIL THE END OF THIS TEXT", "a | b | c | d | e | f | g | h | i | j | k | l"]
    more = spark.createDataFrame([(100, good), (101, bad[0]), (102, bad[1]), (103, f"{good}\n\n\n\nThen they all came home.")], "doc_id long, text string")
    docs = edge.select("doc_id", "text").union(more)
    got = [tuple(r) for r in quality_rules.apply_rules(docs).collect()]
    assert sorted(map(str, (g[:7] for g in got))) == sorted(str((i, *brute_rules(t))) for i, t in source_rows(docs))
    kept = {g[0]: g[7] for g in got}
    assert kept[100] and kept[103] and not kept[101] and not kept[102]
    assert not any(g[7] for g in got if g[6])
    assert quality_rules.apply_rules(empty).count() == 0


def test_rule_order_does_not_change_the_verdict():
    texts = pa.array([t or "" for t in EDGE_TEXTS], pa.large_string())
    rules = list(quality_rules.RULES)
    assert (quality_rules.good(texts, rules) == quality_rules.good(texts, rules[::-1])).all()


def test_sanitiser_base_spans_and_terms(spark, edge, empty):
    importable(spark)
    secret = "Contact Zorblax Quimby at zq@corp.example.com or +49 (30) 1234-5678 or 4111 1111 1111 1111 from 10.0.0.1"
    texts = [(i, f"The note {i} says: {secret} and the rest is for all.") for i in range(4)]
    texts += [(i, f"The weather {i} is fine and the rest is for all and contact is lost.") for i in range(10, 60)]
    texts += [(70, "1.2.3.4.5 999.1.1.1 a@b.c_d@e.f 4111 1111 1111 1112 +12 5 x " + "a" * 4000), (71, None), (72, ""), (None, "q@w.er")]
    docs = spark.createDataFrame(texts + texts[:1], "doc_id long, text string")
    sanitiser = sanitise.Sanitiser(docs)
    got = {r["doc_id"]: r for r in sanitiser.digest().collect()}
    assert sanitiser.digest().count() == len(texts) + 1
    assert tuple(got[0])[1:5] == (1, 1, 1, 1) and tuple(got[70])[1:5] == (2, 1, 0, 0)
    assert got[71]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[71]["spans"] == ""
    t = dict(texts)[70]
    listed = f"ip:{t.index('1.2.3.4')}:{t.index('1.2.3.4') + 7},email:{t.index('a@b')}:{t.index('a@b') + 5},email:{t.index('_d@')}:{t.index('_d@') + 6}"
    assert got[70]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    zorblax = dict(texts)[1].index("Zorblax")
    assert f"remove:{zorblax}:{zorblax + 7}" in got[1]["spans"] and "email:" in got[1]["spans"]
    assert all(got[i]["spans"] == "" for i in range(10, 60))
    clean = {r["doc_id"]: r["text"] for r in sanitiser.sanitised(docs).collect()}
    assert "Zorblax" not in clean[1] and "[EMAIL]" in clean[1] and "weather" in clean[10]
    assert sanitise.Sanitiser(empty).digest().count() == 0
    assert sanitise.Sanitiser(edge).digest().count() == edge.count()


def test_sanitiser_judges_entities_of_one_or_two_rows(spark):
    importable(spark)
    texts = [(i, f"The weather {i} is fine and the rest is for all.") for i in range(100)]
    texts += [(200, "The rest is for Zorblax at zq@corp.example.com and all.")]
    texts += [(i, "The weather is for Quimby at +49 (30) 1234-5678 and all.") for i in (300, 301)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sanitiser = sanitise.Sanitiser(docs)
    clean = dict(sanitiser.sanitised(docs).collect())
    assert clean[200] == "The rest is for [NAME] at [EMAIL] and all."
    assert clean[300] == clean[301] == "The weather is for [NAME] at [PHONE] and all."
    assert all(clean[i] == t for i, t in texts[:100])
    judged = {r["term"]: r["uncertainty"] for r in sanitiser.disclosing.collect()}
    assert judged == pytest.approx({"zorblax": 1.0, "quimby": -math.log2(2 / 3)})


def test_disclosure_does_not_depend_on_the_size_of_the_corpus(spark):
    meetings = [("name", 1, 1, 1, df) for df in range(1, 200)]
    frame = spark.createDataFrame(meetings, "term string, both long, held long, values int, df long")
    frame = frame.withColumn("term", F.concat("term", F.lit("x"), F.col("df").cast("string")))
    frequencies = frame.select("term", "df", F.col("df").alias("cased"))
    for total in (10**3, 10**4, 10**6, 10**8, 10**10):
        found = sanitise.judged(frame.drop("df"), frequencies, total).collect()
        assert [r["df"] for r in found] == [1]
    # An entity that most rows hold is disclosed by nothing.
    assert sanitise.judged(frame.drop("df").withColumn("held", F.lit(600)), frequencies, 1000).count() == 0


def test_sanitiser_agrees_with_plain_counts(spark):
    """All disclosures of a small table, by value and by kind, against counts in plain Python."""
    importable(spark)
    rng = random.Random(8)
    words = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(60)]
    names = ["Vexnor", "Ax9q", "Tilly"]
    people = [f"p{i}@mail.example.com" for i in range(6)] + ["10.0.0.7", "10.0.0.8"]
    texts = []
    for i in range(400):
        said = rng.sample(words, 6) + rng.sample(names, rng.random() < 0.02)
        texts.append(" ".join(said + rng.sample(people, (rng.random() < 0.06) + (rng.random() < 0.02))))
    texts += [f"Zorblax {p} phrase once" for p in people[:2]] * 3
    texts += [f"Quimby or q9 writes from 10.0.0.{i}" for i in (1, 2, 2)] + ["10.0.0.9 Moll", "moll 10.0.0.9", "Tessa"]
    texts += ["Tessa a@mail.example.com", "Tessa b@mail.example.com"]
    texts += texts[:2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sanitiser = sanitise.Sanitiser(docs)

    entity = re.compile(r"[a-z0-9]+@mail\.example\.com|10\.0\.0\.\d")
    held = [set(entity.findall(t)) for t in texts]
    terms = [set(re.findall(r"(?<![^\W_])[^\W\d_][^\W_]{2,}", t)) for t in texts]
    df, cased = collections.Counter(), collections.Counter()
    for found in terms:
        df.update({x.lower() for x in found})
        cased.update({x.lower() for x in found if x != x.lower()})
    kind = lambda e: "email" if "@" in e else "ip"

    def left(term: str, rows: list[int], values: int) -> float | None:
        """Uncertainty if ``term`` discloses what ``rows`` hold."""
        both, n = sum(term in {x.lower() for x in terms[i]} for i in rows), df[term]
        z = 1.0 if re.search(r"\d", term) or 2 * cased[term] >= n else 3.0
        p = both / n
        low = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        bits = math.log2(values) - math.log2(low) if low > 0 else math.inf
        return bits if bits <= 2 and math.log2(low * len(texts) / len(rows)) >= 3 else None

    def wanted(keys: set[str], has, values) -> dict[tuple[str, str], float]:
        found = {}
        for key in keys:
            rows = [i for i in range(len(texts)) if has(i, key)]
            for term in {x.lower() for i in rows for x in terms[i]}:
                bits = left(term, rows, values(key, term))
                if bits is not None:
                    found[key, term] = pytest.approx(bits)
        return found

    by_value = wanted(set().union(*held), lambda i, e: e in held[i], lambda e, term: 1)
    of_term = lambda k, term: {e for i, x in enumerate(terms) if term in {y.lower() for y in x} for e in held[i] if kind(e) == k}
    by_kind = wanted({"email", "ip"}, lambda i, k: k in map(kind, held[i]), lambda k, term: len(of_term(k, term)))
    assert len(by_value) >= 3 and ("email", "zorblax") in by_kind
    assert {(r["kind"], r["term"]): r["uncertainty"] for r in sanitiser.disclosing_kinds.collect()} == by_kind
    values = collections.Counter((t, round(r, 6)) for (_, t), r in ((k, v.expected) for k, v in by_value.items()))
    classes = collections.Counter((r["term"], round(r["uncertainty"], 6)) for r in sanitiser.disclosing.collect())
    assert set(classes) == set(values)  # entities of the same rows are one class


def test_sanitiser_marks_terms_of_whole_documents(spark):
    importable(spark)
    plain = "The rest is for all and the weather is fine."
    texts = [(i, plain) for i in range(100)]
    far = f"Zorblax. {f'{plain} ' * 10}The rest is zq@corp.example.com! {f'{plain} ' * 50}zorblax"
    texts += [(200, far), (201, f"{plain} 10.0.0.1 Zorblax {plain} 10.0.0.1"), (None, plain), (200, far)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sanitiser = sanitise.Sanitiser(docs)
    clean = sorted(t for i, t in sanitiser.sanitised(docs).collect() if i == 200)
    wanted = far.replace("zq@corp.example.com", "[EMAIL]").replace("Zorblax", "[NAME]").replace("zorblax", "[NAME]")
    assert clean == [wanted] * 2
    spans = {r["doc_id"]: r["spans"] for r in sanitiser.digest().collect()}
    for at in (0, len(far) - 7):
        assert f"generalise:{at}:{at + 7}" in spans[200].split(",")
    assert spans[None] == "" and sanitiser.digest().count() == len(texts)
    # Texts of many terms and entities are listed block by block.
    many = " ".join(f"w{i}x a{i}@b.cd" for i in range(700))
    docs = spark.createDataFrame([(0, many), *((i, plain) for i in range(1, 50))], "doc_id long, text string")
    found = sanitise.Sanitiser(docs).spans().filter("doc_id = 0").first()
    assert [(t["s"], many[t["s"] : t["e"]]) for t in sorted(found["terms"])] == [
        (m.start(), m[0]) for m in re.finditer(r"(?<!\S)w\d+x", many)
    ]
    assert [many[x["s"] : x["e"]] for x in found["base"]] == [f"a{i}@b.cd" for i in range(700)]


def test_mixing_targets_and_shards(spark, edge, empty, monkeypatch):
    importable(spark)
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 64)
    monkeypatch.setattr(mixing, "BLOCKS_PER_SHARD", 4)
    rng = random.Random(5)
    docs = spark.createDataFrame(
        [(i, "w " * rng.randrange(0, 60), "hot" if i % 3 == 0 else f"s{i % 7}", "x") for i in range(900)]
        + [(2000, "a b c", None, "x"), (2001, None, "void", "x")],
        "doc_id long, text string, source string, shard string",
    )
    mix = mixing.Mix(docs)
    got = mix.taken().collect()
    again = mixing.Mix(docs.repartition(5)).taken().collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes, target, taken = collections.Counter(), {}, collections.Counter()
    names = {r["doc_id"]: r["source"] for r in docs.collect()}
    for r in got:
        s = names[r["doc_id"]]
        sizes[s] += r["size"]
        target[s] = r["target"]
        taken[s] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    free, left, wanted = set(order), float(sum(sizes.values())), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not above:
            wanted |= {s: weight[s] * level for s in free}
            break
        wanted |= {s: 3.0 * sizes[s] for s in above}
        left -= sum(3 * sizes[s] for s in above)
        free -= above
    assert target == pytest.approx(wanted)
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)
    blocks = mix.blocks.collect()
    shards = collections.Counter(b["shard"] for b in blocks)
    assert len(shards) > 4 and max(shards.values()) <= 4
    assert len({(b["sid"], b["position"]) for b in blocks}) == len(blocks)
    mixed = mix.mixed(docs)
    assert mixed.columns == docs.columns
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert max(copies.values()) <= 3 and 2000 in copies
    assert mixing.Mix(empty).taken().count() == 0 and mixing.Mix(empty).mixed(empty).count() == 0
    assert mixing.Mix(edge).taken().count() == edge.count()


def test_hypergeometric_draws_have_the_right_mean(spark):
    nodes = spark.range(4000).select(
        (F.col("id") + 1).alias("node"),
        F.lit(60).cast("long").alias("slots"),
        F.expr("array(named_struct('sid', 1, 'k', 10L), named_struct('sid', 2, 'k', 45L), named_struct('sid', 3, 'k', 5L))").alias("quota"),
    )
    halves = mixing.split_node(nodes, 9).filter("node % 2 = 0").select("node", "slots", F.explode("quota").alias("q"))
    assert halves.groupBy("node").agg(F.sum("q.k").alias("n")).filter("n <> 30").count() == 0
    stats = {r[0]: (r[1] / 4000, r[2]) for r in halves.groupBy("q.sid").agg(F.sum("q.k"), F.var_pop("q.k")).collect()}
    for sid, k in ((1, 10), (2, 45), (3, 5)):
        variance = 30 * k / 60 * (1 - k / 60) * 30 / 59
        assert stats[sid][0] == pytest.approx(k / 2, abs=5 * math.sqrt(variance / 4000))
    assert stats[2][1] == pytest.approx(30 * 45 / 60 * 15 / 60 * 30 / 59, rel=0.15)


def test_quality_classifier_learns_and_holds_out(spark, edge, empty):
    importable(spark)
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "bcdfghklmn" for b in ("an", "el", "ist", "or", "un")]
    docs, labels = [], []
    for i in range(900):
        good = i % 3 > 0
        t = [rng.choice(words) for _ in range(rng.randrange(20, 80))]
        docs.append((i, " ".join(t) if good else " | ".join(t), "x"))
        labels.append((i, int(good) if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - int(good)))
    labels += [(5, None), (None, 1), (6, labels[6][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality_classifier.classify(df, known).collect()
    assert len(got) == len(docs)
    # Held-out labels are turned round, so learning from any of them would show.
    right = [r["predicted"] == int(r["doc_id"] % 3 > 0) for r in got if r["held_out"]]
    assert sum(right) >= 0.97 * len(right) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_classifier.classify(empty, known).count() == 0
    none = quality_classifier.classify(edge, known.limit(0)).collect()
    assert len(none) == edge.count() and {r["score"] for r in none} == {0.5}


def test_words_are_cut_at_ascii_white_space_only():
    texts = pa.array(["", " a  b\t", "c\x0bd\x0ce\r\nf", "g h\x1ci"], pa.large_string())
    words, n = split_words(texts)
    assert n.tolist() == [0, 2, 4, 1] and words.to_pylist() == ["a", "b", "c", "d", "e", "f", "g h\x1ci"]


def test_blocks_of_walks_and_chunks_agree_with_plain_loops():
    rng = random.Random(3)
    text = decontaminate.letters("".join(rng.choice("ab c") for _ in range(3 * decontaminate._AT_ONCE)))
    places = decontaminate.word_starts(text)
    assert len(places) > decontaminate._AT_ONCE // 2
    places = np.concatenate([places, places, places])
    keys, ends = decontaminate.walk(text, places, 2)
    for i in (0, decontaminate._AT_ONCE - 1, decontaminate._AT_ONCE, len(places) - 1):
        at, taken = int(places[i]), []
        for step in range(decontaminate._SAMPLED[2][-1] + 1):
            taken += [int(text[at])] if step in decontaminate._SAMPLED[2] else []
            at += int(decontaminate._BITS[2, step][text[at]]) if step < decontaminate._SAMPLED[2][-1] else 0
        key = 3
        for c in taken:
            key = (key * 0x100000001B3 + c) % (1 << 64)
        assert (int(keys[i]), int(ends[i])) == (int(decontaminate.mix64(np.array([key], np.uint64))[0]), at)

    sizes = np.array([64, 1, 9, 33], np.int64)
    chunks = ["".join(rng.choice("abc ") for _ in range(n)) for n in sizes]
    masks = np.zeros((4, 256), np.uint64)
    for mask, chunk in zip(masks, chunks):
        for i, c in enumerate(chunk):
            mask[ord(c)] |= np.uint64(1 << i)
    start = np.array([rng.randrange(len(text)) for _ in range(40)] + [len(text) - 3])
    which = np.arange(41) % 4
    got = decontaminate.chunk_distances(masks, sizes, which, text, start)
    for w, s, best in zip(which, start, got):
        stretch = [int(text[min(s + j, len(text) - 1)]) for j in range(64 + 2 * decontaminate._SLACK)]
        row, least = list(range(sizes[w] + 1)), int(sizes[w])
        for c in stretch:
            new = [0]
            for i, x in enumerate(chunks[w]):
                new.append(min(row[i] + (ord(x) != c), row[i + 1] + 1, new[i] + 1))
            row, least = new, min(least, new[-1])
        assert best == least


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_cover_their_tables(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    table = "pages" if name.startswith("op2_") else "documents"
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert df.count() == rows or name.startswith("op5_")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, folder = docs.columns, run_folder(spark, "test-pipeline")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if name != "tokens":
            assert docs.columns == columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_near_duplicate_stage_matches_brute_force(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()}
    texts = source_rows(docs)
    assert kept == {i for i, _, c in brute_components(texts, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILAR_PERCENT) if i == c}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_quality_stage_decides_rows(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_low_quality(spark, docs, SF_DIR).collect()}
    lost = docs.count() - len(kept)
    assert kept and lost
    texts = collections.Counter(r["text"] for r in docs.collect() if r["doc_id"] in kept)
    # One id for all rows, and none: the same texts stay. What is learnt from labels by id is kept by a second, named copy.
    for same in (F.lit(None).cast("long"), F.lit(10**12)):
        both = docs.unionByName(docs.withColumn("doc_id", same).withColumn("text", F.concat("text", F.lit(" "))))
        rows = corpus_pipeline.drop_low_quality(spark, both.withColumn("key", F.lit("k")), SF_DIR)
        assert rows.columns == [*docs.columns, "key"]
        got = [(r["doc_id"], r["text"]) for r in rows.collect()]
        named = collections.Counter(t for i, t in got if i not in (None, 10**12))
        other = collections.Counter(t[:-1] for i, t in got if i in (None, 10**12) and t is not None)
        assert named == other + collections.Counter(t for t in named.elements() if t is None)
        assert 0 < sum(named.values()) < docs.count()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_pipeline_stages_on_rows_without_ids_and_empty_tables(spark):
    import corpus_pipeline

    base = " ".join(f"w{i}" for i in range(60))
    rows = [(5, base), (None, base), (None, base + " more"), (None, "alone " + " ".join(f"v{i}" for i in range(40)))]
    rows += [(None, rows[3][1]), (None, None), (None, ""), (7, None), (8, " "), (9, "short"), (None, "short"), (9, "short")]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, source string, _id long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    wanted = [(5, base), rows[3], (None, None), (None, ""), (7, None), (8, " "), (9, "short"), (9, "short")]
    assert collections.Counter((r["doc_id"], r["text"]) for r in got.collect()) == collections.Counter(wanted)
    none = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter(F.lit(False))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF_DIR).count() == 0, name
