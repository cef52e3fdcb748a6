"""Memory and disk of single tasks."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from tidemark.llm import queries, toxicity
from tidemark.llm.words import pieces


def test_toxicity_is_scored_in_small_slices(spark, monkeypatch):
    queries.reachable(spark)
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    model, given = (np.array([0, 5, 1 << 20]), np.array([0.5, 1.0, 0.25])), []
    monkeypatch.setattr(toxicity, "with_text_columns", lambda df, text, fields, function, *most: given.append((function, *most)) or df)
    toxicity.score_toxicity(docs, model)
    function, *most = given[0]
    texts = pa.array([" ".join(f"word{(7 * k + j) % 5003}" for j in range(300)) for k in range(1000)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    whole = function(texts)[0].to_numpy()
    tracemalloc.start()
    parts = [function(b.column("text"))[0].to_numpy() for b in pieces(iter([batch]), "text", *most)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # 4 MB at a time took over 100
    assert np.allclose(np.concatenate(parts), whole, rtol=1e-12)


def test_distinct_words_are_encoded_in_one_call():
    from tidemark.llm import shards

    calls = []

    class Counted:
        def __init__(self, encoding):
            self.encoding = encoding

        def __getattr__(self, name):
            calls.append(name)
            return getattr(self.encoding, name)

    tokenizer = shards.Tokenizer(*shards._ranks(None), 400_000)
    plain, tokenizer.encoding = tokenizer.encoding, Counted(tokenizer.encoding)
    texts = [" ".join(f"w{(31 * k + j) % 997}'s, çö漢" for j in range(50)) for k in range(40)]
    texts += ["foo\n", "\nfoo bar\n", "a b\tc d", "x\ny z", "", None, "  two", "it's we'll 123 !!!", "'s 're a\r", "<|endoftext|> a"]
    ids, offsets = tokenizer.batch(pa.array(texts))
    assert len(calls) < 100  # one a word took over 900
    for k, text in enumerate(texts):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == plain.encode_ordinary(text or "")


def test_usual_words_are_solved_together(monkeypatch):
    from tidemark.llm import pieces as sp

    model = sp.Model(sp.default_path())
    plain, encoder = sp.Encoder(model, 400_000), sp.Encoder(model, 400_000)
    calls, path = [], sp.Model.path
    monkeypatch.setattr(sp.Model, "path", lambda self, *a: calls.append(a) or path(self, *a))
    texts = [" ".join(f"w{(31 * k + j) % 997}unzusammenhängend's," for j in range(50)) for k in range(40)] + ["foo\n", "a b\tc d", "", None, "  two", "漢字 ok ÿ\x85 \x00", "▁a b▁c", "x" * 80 + " " + "y" * 64]
    ids, offsets = encoder.batch(pa.array(texts))
    assert len(calls) < 20  # one a word took over 900
    for k, text in enumerate(texts):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == plain.text(text or "")
    text = sp.normalised(" ".join(t or "" for t in texts))
    fresh = sp.Encoder(model, 400_000)
    fresh.learn([text], weights=False)
    assert fresh.known and not fresh.weights and all(ids == plain.word(w) for w, ids in fresh.known.items())
    fresh.learn([text], weights=True)
    assert fresh.weights.keys() == fresh.known.keys() and all(n == plain.weight(w) for w, n in fresh.weights.items())


def test_rows_of_one_widespread_passage_are_no_group(spark, monkeypatch):
    import random

    from tidemark.llm import jaccard

    queries.reachable(spark)
    rng, passage = random.Random(3), " ".join(f"p{k}" for k in range(12))
    rows = [(k, " ".join(f"v{rng.randrange(10**9)}" for _ in range(10)) + " " + " ".join(passage.split()[k % 6:k % 6 + 6])) for k in range(300)]
    rows += [(k + 1000, rows[k][1] + " more") for k in range(5)]
    kept, staged = {}, jaccard.staged
    monkeypatch.setattr(jaccard, "staged", lambda df, name: kept.setdefault(name, []).append(staged(df, name)) or kept[name][-1])
    monkeypatch.setattr(jaccard, "dropped", lambda *tables: None)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k - 1000 if k >= 1000 else k for k, _ in rows}
    assert kept["alike-rows"][0].count() <= 10


def long_texts(rng, count, wide, narrow):
    """Unlike texts that share ``wide`` phrases of 5 words with 20 others each and ``narrow`` ones with one other."""
    texts = [[] for _ in range(count)]
    for texts_of, phrases in ((20, count * wide // 20), (2, count * narrow // 2)):
        for k in range(phrases):
            for t in rng.sample(range(count), min(texts_of, count)):
                texts[t].append(" ".join(f"s{texts_of}_{k}_{j}" for j in range(5)))
    return [" ".join(rng.sample(t, len(t))) for t in texts]


def test_long_texts_that_share_phrases_by_chance_are_no_group(spark, monkeypatch):
    import random

    from tidemark.llm import jaccard

    queries.reachable(spark)
    texts = long_texts(random.Random(7), 200, 10, 45)
    rows = [*enumerate(texts), *((k + 1000, texts[k] + " more") for k in range(5))]
    kept, staged = {}, jaccard.staged
    monkeypatch.setattr(jaccard, "staged", lambda df, name: kept.setdefault(name, []).append(staged(df, name)) or kept[name][-1])
    monkeypatch.setattr(jaccard, "dropped", lambda *tables: None)
    settings = jaccard.Settings(frequent_bound=0)  # as n-grams too seldom to be known
    got = {r["doc_id"]: r["component_id"] for r in jaccard.join_similar(spark.createDataFrame(rows, "doc_id long, text string"), settings).collect()}
    assert got == {k: k - 1000 if k >= 1000 else k for k, _ in rows}
    assert kept["alike-rows"][0].count() <= 30  # 182 when every wide column joined its rows


def test_links_through_wide_columns_are_found(spark):
    import random
    from itertools import combinations

    from tidemark.llm import jaccard

    queries.reachable(spark)
    rng, texts = random.Random(11), []
    for base in long_texts(rng, 12, 20, 20) + [f"a{k} b c d e" for k in range(4)]:
        words = base.split()
        for _ in range(9):  # versions at, below and above the least similarity, some of other sizes
            new, at = list(words), rng.randrange(max(1, len(words) - 8))
            new[at:at + rng.randrange(9)] = [f"y{rng.randrange(99)}" for _ in range(rng.randrange(5))]
            texts.append(" ".join(new[:rng.choice([len(new), len(new) - len(new) // 8])]))
    sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in map(str.split, texts)]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in combinations(range(len(texts)), 2):
        if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
            lo, hi = sorted((root(x), root(y)))
            parent[hi] = lo
    want = {k: root(k) for k in range(len(texts))}
    assert len(set(want.values())) < len(want) - 20
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    for settings in (jaccard.Settings(frequent_bound=0), jaccard.Settings(narrow=2, share=10), jaccard.Settings(narrow=1, meet=3, share=20, frequent_bound=0)):
        assert {r["doc_id"]: r["component_id"] for r in jaccard.join_similar(df, settings).collect()} == want


def test_stored_tables_of_the_join_go_early(spark, monkeypatch):
    from tidemark.llm import components, jaccard

    queries.reachable(spark)
    words = [f"w{k}" for k in range(60)]
    docs = spark.createDataFrame([(k, " ".join(words[:50] + [f"x{k}"])) for k in range(20)], "doc_id long, text string")
    tables, staged = [], jaccard.staged
    for module in (jaccard, components):
        monkeypatch.setattr(module, "staged", lambda df, name: tables.append((name, staged(df, name))) or tables[-1][1])
    got = {r["component_id"] for r in jaccard.join_similar(docs).collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    left = []
    for name, df in tables:
        files = df.inputFiles()
        at = path(files[0])
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            left.append(name)
    assert got == {0} and sorted(left) == ["alike", "set-numbers", "similar"]


def test_overlaps_of_a_block_are_counted_in_slices():
    from tidemark.llm import jaccard

    rng = np.random.default_rng(5)
    common = np.sort(rng.choice(1 << 40, 600, replace=False).astype(np.uint64))
    sets = [np.delete(common, rng.choice(600, 130, replace=False)) for _ in range(1500)]
    sizes = np.array([len(x) for x in sets])
    tracemalloc.start()
    edges = jaccard.link_block(sizes, sets, 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25e6  # 42 MB when all overlaps of a row were counted at once, with eight bytes for each number
    assert sorted(edges) == sorted(jaccard.link_block(sizes, sets, 64, most=1 << 40)) and len(edges) > 1000


def test_only_likely_rows_are_joined_with_their_texts(spark):
    from tidemark.llm.frames import likely

    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('x', 10) AS text").unionByName(spark.createDataFrame([(None, "n")], "doc_id long, text string"))
    chosen = spark.range(0, 20_000, 97).selectExpr("id AS doc_id", "id AS want")
    got = likely(docs, chosen, "doc_id")
    assert got.columns == ["doc_id", "text"]
    ids = [r["doc_id"] for r in got.collect()]
    assert set(range(0, 20_000, 97)) <= set(ids) and len(ids) == len(set(ids)) < 300


def test_long_texts_are_spelled_a_few_at_a_time():
    from types import SimpleNamespace

    from pyspark.sql import types as T

    from tidemark.llm import pieces as sp

    class Stored:
        columns = ["ids"]
        schema = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
        sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda v: SimpleNamespace(value=v)))

        def mapInArrow(self, function, schema):  # noqa: N802
            return function

    encoder = sp.Encoder(sp.Model(sp.default_path()), 1_000)
    ids = encoder.text("some words of a long text " * 9_000)
    lists = pa.array([ids] * 40 + [[], None, encoder.text("one"), encoder.text("ÿ 漢")], pa.list_(pa.int32()))
    made = list(sp.decode_documents(Stored())(iter([pa.RecordBatch.from_arrays([lists], names=["ids"])])))
    assert [t for b in made for t in b.column("text").to_pylist()] == ["some words of a long text " * 9_000] * 40 + ["", "", "one", "ÿ 漢"]
    assert all(b.num_rows == 1 or len(b.column("ids").flatten()) <= 1 << 18 for b in made)  # all 40 were spelled at once
    assert all(type(x) is bytes for x in encoder.known.values())  # not lists of numbers
    assert [b.num_rows for b in sp.few(iter(made[:1]), 2)][0] == min(2, made[0].num_rows)
