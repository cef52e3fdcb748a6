"""Collocations and spelling variants against brute force, on odd rows, and across routes and partitions."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import collocations, queries, spelling

SCHEMA = "doc_id long, text string, lang string, word string, n long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    queries.reachable(spark)
    own = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", F.lit("x").alias("word"), F.lit(1).cast("long").alias("n"))
    hot = "the hot pair goes " + " the hot pair ".join(f"w{k % 40}" for k in range(3000))
    ties = ". ".join("colour variants\tcolours colours, color! Éclairé éclairé ×÷×÷×÷ aabbccd abbccd aabbcd" for _ in range(40))
    odd = [(9001, None, None, None, None), (9002, "", "en", None, 1), (9003, " .,; \n\r", None, None, 1), (9004, hot, "en", None, 1), (9004, hot, "en", None, 1),
           (None, ties, None, None, 1), (9005, ties + " colours" * 300, "zz", None, 1), (9006, "x" * 3000 + " " + "y" * 300, "en", None, 1)] + [(9100 + k, "Q" * 400, "en", None, 1) for k in range(6)]
    return own.unionByName(spark.createDataFrame(odd, SCHEMA)).cache()


@pytest.fixture(scope="module")
def local(docs):
    return docs.select("doc_id", "text", "lang").collect()


@pytest.fixture
def many_tasks(spark):
    """No small partitions are merged, so words and suffixes are dealt over all of them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def phrases(rows, top=2000):
    f, n, out = Counter(), Counter(), []
    for r in rows:
        lang = r["lang"] or "und"
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower(r["text"])):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= 30}
    longest = defaultdict(int)
    for (lang, w), a in candidates.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longest[lang, w[i:i + m]] = max(longest[lang, w[i:i + m]], a)
    by = defaultdict(list)
    for (lang, w), a in candidates.items():
        if 100 * longest[lang, w] < 80 * a:
            score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            by[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    for lang in sorted(by):
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(by[lang])[:top])]
    return out


@pytest.mark.parametrize("settings", [{}, {"per_route": 700, "heavy": 20}, {"per_route": 50, "heavy": 3, "top": 7}])
def test_collocations(docs, local, many_tasks, settings):
    found = collocations.collocations(docs, settings=collocations.Settings(**settings))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [tuple(r) for r in found.orderBy("lang", "rank").collect()] == phrases(local, settings.get("top", 2000))


def test_the_hot_pair_is_heavy(docs):
    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    seen = collocations.heavy_prefixes(texts, 20)
    total = seen.filter("size = 0").agg(F.sum("n")).first()[0]
    assert seen.filter(F.col("size") == 2).filter(F.col("n") * 20 > total).count() >= 1


def test_exact_products(spark):
    big = spark.createDataFrame([(9_000_000_000_000_000, 9_000_000_000_000_001)], "a long, b long")
    assert big.select(collocations.exact_floor(2_000_000, F.col("a"), F.col("b"))).first()[0] == 2_000_000 * 9_000_000_000_000_000 // 9_000_000_000_000_001


def test_multikey_sort_leaves_light_parts():
    import numpy as np

    rng = np.random.default_rng(3)
    words = rng.integers(1, 6, (4000, 4))
    for k in (1, 2, 3):
        words[rng.random(4000) < 0.1, k:] = 0
    weights = rng.integers(1, 4, 4000)
    want = Counter()
    for row, weight in zip(words.tolist(), weights.tolist(), strict=True):
        size = row.index(0) if 0 in row else 4
        for k in range(2, size + 1):
            want[tuple(row[:k])] += weight
    assert dict(collocations.frequent_prefixes(words, weights, [30] * 4)) == {k: n for k, n in want.items() if n >= 30}
    assert dict(collocations.frequent_prefixes(words, weights, [1, 1, 30, 30])) == {k: n for k, n in want.items() if n >= 30 or len(k) == 2}


def variants(rows):
    n = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{word}".encode())
            if h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            n[word] += len(word) >= 6
    n = {w: k for w, k in n.items() if k >= 5}
    near = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            near["gap", w[:i], w[i + 1:]].add(w)
    met = defaultdict(set)
    for group in list(near.values()):
        for a in group:
            met[a] |= group - {a}
    for w in n:
        for i in range(len(w)):
            u = w[:i] + w[i + 1:]
            if u in n:
                met[w].add(u)
                met[u].add(w)
    form = {w: min(met[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: f if f and n[f] >= 5 * n[w] else None for w, f in form.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(met[w]), n.get(form[w])) for w in n)


def test_spelling_variants(docs, local, many_tasks):
    found = spelling.group_variants(docs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = variants(local)
    assert sorted(tuple(r) for r in found.collect()) == want and any(r[1] for r in want) and any(r[0] == "q" * 400 for r in want)


def test_chains_of_forms(spark):
    queries.reachable(spark)
    words = {"aaaaaaa": 5, "aaaaaab": 25, "aaaaabb": 125, "aaaabbb": 625, "aaaabbbb": 3125, "aaaacbb": 620, "banana": 7, "bananas": 30}
    df = spark.createDataFrame([(k, " ".join([w] * n), None, None, None) for k, (w, n) in enumerate(words.items())], SCHEMA)
    # the deletions depend on ids, so ids under which no word loses a character are used
    ids = [next(i for i in range(k * 1000, 10**6) if zlib.crc32(f"{i}:{w}".encode()) % 199) for k, w in enumerate(words)]
    df = spark.createDataFrame([(i, r["text"], None, None, None) for i, r in zip(ids, df.collect(), strict=True)], SCHEMA)
    got = sorted(tuple(r) for r in spelling.group_variants(df).collect())
    assert got == variants([{"doc_id": i, "text": " ".join([w] * n)} for i, (w, n) in zip(ids, words.items(), strict=True)])
    assert ("aaaaaaa", "aaaaaab", "aaaabbbb", 5, 1, 25) in got


def test_nodes_are_shared_over_partitions(spark, many_tasks):
    queries.reachable(spark)
    words = sorted({f"{a}{b}{c}" for a in ("pre", "pro") for b in "abcdefgh" for c in ("x", "xy", "xyz", "")})
    nodes = spelling.number_nodes(spark.createDataFrame([(w,) for w in words], "word string"), "word").collect()
    assert len(nodes) == len(words) and len({r["_nodes"][1] >> 40 for r in nodes}) == 1
    by = defaultdict(set)
    for r in nodes:
        for k, node in enumerate(r["_nodes"]):
            by[r["word"][:k]].add(node)
    assert all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)
    assert [r["word"] for r in sorted(nodes, key=lambda r: r["_rank"])] == words


def test_checksums():
    import numpy as np

    raw = np.frombuffer("ab éèx ".encode() * 300, dtype=np.uint8)
    starts, lens = np.array([0, 3, 5, 0, 7]), np.array([2, 0, 700, 257, 256])
    seeds = np.array([zlib.crc32(f"{k}:".encode()) for k in range(5)], dtype=np.uint32)
    want = [zlib.crc32(f"{k}:".encode() + raw[a:a + n].tobytes()) for k, (a, n) in enumerate(zip(starts, lens, strict=True))]
    assert spelling.continued_crc(seeds, raw, starts, lens).tolist() == want


def test_empty_tables(spark):
    queries.reachable(spark)
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).count() == 0 and spelling.group_variants(empty).count() == 0
