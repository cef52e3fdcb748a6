"""Each operator against a brute-force version, and on nulls, empty tables, repeated rows and extra columns."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import chat, decontaminate, html, jaccard, katz, passages, pieces, queries, rules, shards, toxicity
from tidemark.llm.components import components
from tidemark.llm.words import hash_words

SCHEMA = "doc_id long, text string, lang string, score double, kept string"


def split(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.fixture(scope="module")
def docs(spark):
    """Documents of the smallest tables, with odd rows and columns whose names clash."""
    queries.reachable(spark)
    own = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", F.lit(0.5).alias("score"), F.lit("x").alias("kept"))
    long = " ".join(f"w{k % 977}" for k in range(9000))
    odd = [(9001, None, None, None, None), (9002, "", "en", 1.0, "a"), (9003, " \t\n", "en", 1.0, "a"), (9004, "one", "en", 1.0, "a"), (9005, "ONE", "en", 1.0, "a"),
           (9006, long, "en", 1.0, "a"), (9006, long, "en", 1.0, "a"), (None, "a row without an id", "en", 1.0, "a"), (9007, "  two  spaces ▁ mark ", "en", 1.0, "a")]
    return own.unionByName(spark.createDataFrame(odd, SCHEMA)).cache()


@pytest.fixture(scope="module")
def labels(spark):
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (9002, 1, 0), (9002, 1, 0)], "doc_id long, quality int, toxic int")
    return spark.read.parquet(f"{SF}/labels.parquet").unionByName(odd)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def local(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def test_equal_words_have_equal_numbers():
    texts = ["", None, " a  B\tc\x0b\n", "A b", "ab", " x Éa", "x" * 300_000 + " y a", " " * 200_000 + "a"]
    numbers, offsets = hash_words(pa.array(texts))
    assert [len(split(t)) for t in texts] == np.diff(offsets).tolist()
    found = {}
    assert all(found.setdefault(w, n) == n for w, n in zip([w for t in texts for w in split(t)], numbers.tolist(), strict=True))
    assert len(set(found.values())) == len(found)


def test_components(spark):
    edges = [(5, 4), (4, 3), (9, 8), (3, 1), (8, 9), (7, 7)] + [(100 + k, 101 + k) for k in range(40)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {5: 1, 4: 1, 3: 1, 1: 1, 9: 8, 8: 8} | {100 + k: 100 for k in range(41)}


def test_toxicity_finds_held_out_documents(docs, labels):
    sample_labels = labels.filter("toxic IS NOT NULL")
    model = toxicity.train_on(docs, sample_labels)
    got = toxicity.score_toxicity(docs.drop("score"), model)
    assert got.count() == docs.count() and got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    held = got.filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2).join(sample_labels.dropna().dropDuplicates(["doc_id"]), "doc_id")
    assert held.filter((F.col("score") >= 0.3) != (F.col("toxic") == 1)).count() <= 0.2 * held.count()
    assert len(model[0]) < 20_000  # compact


def test_toxicity_stage_and_empty_tables(docs, labels, empty):
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert kept.filter("doc_id = 9006").count() in (0, 2)  # repeated rows fare alike
    assert toxicity.drop_toxic(empty, labels).count() == 0
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == docs.count()


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k:k + 8])].append(k)
    covered = {k + j for v in windows.values() if len(v) > 1 for k in v for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(docs, labels, local):
    got = rules.judge(docs.drop("kept"), labels)
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r["doc_id"], *(r[c] for c in columns), r["base_failed"]) for r in got.collect()) == Counter(
        (i, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]) for i, t in local for c in [brute_counts(t)])
    assert got.filter("base_failed AND kept").count() == 0


def test_binomial_tail_is_exact(spark):
    cases = [(0, 500, 0.01), (3, 1000, 0.01), (150, 20_000, 0.01), (7, 40, 0.25)]
    df = spark.createDataFrame([(float(k), float(n), p) for k, n, p in cases], "k double, n double, p double")
    got = [r[0] for r in df.select(rules.log_binomial_tail(F.col("k"), F.col("n"), F.col("p"))).collect()]
    for value, (k, n, p) in zip(got, cases, strict=True):
        assert value == pytest.approx(math.log(sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))), abs=1e-8)


MEASURED = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long, n_exclamations long"


def test_cutoffs_keep_their_promise(spark):
    """Good texts that any rule rejects stay below the certified share; a small stratum has no cutoff."""
    rows = [(k, lang, 60, 100, k * 7919 % 100 // 97 * (1 + k % 40), 0, k * 31 % 60 // 59 * (k % 17), 5, k % 3, 0) for lang, ids in (("big", range(6000)), ("mid", range(6000, 6300)), ("small", range(10_000, 10_150))) for k in ids]
    measured = spark.createDataFrame(rows, MEASURED)
    table = rules.cutoffs(measured, measured.select("doc_id", F.lit(1).alias("quality")))
    found = {r["stratum"]: r for r in table.collect()}
    assert found["small"]["level"] is None and found["small"]["symbol_share"] is None
    assert found["big"]["level"] >= 0 and found["big"]["exclamations"] == 0 and found["mid"]["level"] is not None
    judged = rules.verdict(measured, table, certified="sure")
    lost = {r["lang"]: (r["lost"], r["sure"]) for r in judged.groupBy("lang").agg(F.avg(F.when(F.col("kept"), 0).otherwise(1)).alias("lost"), F.max("sure").alias("sure")).collect()}
    assert 0 < lost["big"][0] <= 0.02 and lost["mid"][0] <= 0.02 and lost["small"] == (0, False) and lost["big"][1]


def test_cutoffs_against_brute_force(spark):
    """Levels, the walk of exact bounds and the joint cutoffs, recomputed text by text."""
    s = rules.Settings()
    rows = [(k, ("a", "b", None)[k % 3], 60, 200, k * 37 % 53 // 40 * (k % 11), k * 13 % 29 // 27, 0, 5, k * 17 % 41, k % 5) for k in range(3000)]
    measured = spark.createDataFrame(rows, MEASURED)
    table = {r["stratum"]: r for r in rules.cutoffs(measured, measured.select("doc_id", F.lit(1).alias("quality"))).collect()}
    path = {r[0] for r in measured.filter(F.pmod(F.xxhash64("doc_id"), F.lit(s.path_of)) == 0).select("doc_id").collect()}
    steps = {r[0]: [math.ceil(min(1.0, v) * s.steps) for v in (r[4] / r[3], r[5] / r[7], r[6] / r[2], r[8] / r[3], r[9] / r[2])] for r in rows}
    ordered = [[steps[k][m] for k in path] for m in range(5)]

    def level(k):
        found = []
        for m in range(5):
            at = [x for x in ordered[m] if x >= steps[k][m]]
            found.append(math.ceil(len(at) * s.levels / len(path)) if at else 0)
        return min(found)

    def tail(k, n, p):
        return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log(1 - p)) for i in range(k + 1))

    for stratum in ("a", "b", "\0"):
        own = [level(r[0]) for r in rows if (r[1] or "\0") == stratum and r[0] not in path]
        certified = None
        for c in range(s.levels + 1):
            k = sum(x <= c for x in own)
            if k >= len(own) * s.alpha or tail(k, len(own), s.alpha) > s.delta / 3:
                break
            certified = c
        assert (table[stratum]["good"], table[stratum]["level"]) == (len(own), certified)
    got = {r["doc_id"]: r["kept"] for r in rules.verdict(measured, rules.cutoffs(measured, measured.select("doc_id", F.lit(1).alias("quality")))).collect()}
    assert got == {r[0]: (table[r[1] or "\0"]["level"] is None or level(r[0]) > table[r[1] or "\0"]["level"]) for r in rows}


def test_quality_rules_on_empty_tables(labels, empty, docs):
    assert rules.judge(empty.drop("kept"), labels).count() == 0
    alone = rules.judge(docs.drop("kept"), labels.limit(0))
    assert alone.count() == docs.count() and alone.filter("certified OR kept = base_failed").count() == 0


def test_quality_stage(docs, labels, empty):
    kept = rules.drop_rejected(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert rules.drop_rejected(empty, labels).count() == 0


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = split(t)
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root, at = {i: i for i in sets}, defaultdict(list)
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, s in sets.items():
        for g in s:
            at[g].append(i)
    for a, b in {(a, b) for v in at.values() for a in v for b in v if a < b}:
        common = len(sets[a] & sets[b])
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_against_brute_force(spark, docs, local):
    """Also with small blocks, so that one group is cut, and edits that lie near the threshold."""
    base = [f"t{k}" for k in range(60)]
    edited = [(20_000 + k, " ".join(w if j % 60 != k and (k % 3 or j != 40) else f"e{k}" for j, w in enumerate(base))) for k in range(40)]
    chain = [(30_000 + k, " ".join(f"c{j}" for j in range(k * 3, k * 3 + 60))) for k in range(12)]
    rows = [r for r in local if r[0] is not None and r[0] != 9006] + edited + chain
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    for settings in (jaccard.Settings(), jaccard.Settings(block_rows=7, meet=2, narrow=3)):
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_similar(df, settings).collect()} == want


def test_jaccard_stage(docs, empty):
    kept = jaccard.keep_one_per_group(docs)
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns and ids.count(9006) == 1 and ids.count(None) == 1 and 9004 in ids and 9005 not in ids
    assert {9001, 9002, 9003} <= set(ids) and jaccard.keep_one_per_group(empty).count() == 0


def test_leaks_and_paraphrases(spark, docs, empty):
    item = "the quick zebra jumps near forty tall lamps while seven grey owls watch from mossy roofs and the answer is quartz lantern nine"
    loose = "the quick zebra hops near forty very tall lamps while seven grey owls look from mossy roofs and so the answer is quartz lantern nine"
    wrong = "the quick zebra hops by forty tall poles while nine red owls gaze from flat roofs thus one reply was copper bucket two"
    filler = " ".join(f"filler{k} word{k % 7}" for k in range(60))
    own = spark.createDataFrame([(1, f"{filler} {item} {filler}"), (2, f"{filler} {loose} {filler}"), (3, f"{filler} {wrong}"), (4, None), (5, ""), (None, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (7, item), (8, None), (None, "x"), (9, "")], "item_id long, text string")
    got = sorted((r["doc_id"] or 0, r["item_id"]) for r in decontaminate.find_leaks(own.unionByName(docs.select("doc_id", "text")), bench).collect())
    assert got == [(0, 7), (1, 7), (2, 7)]
    assert decontaminate.drop_leaks(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.find_leaks(empty, bench).count() == 0


def test_leak_recall(docs, spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows, items = docs.select("doc_id", "text").dropna().collect(), bench.collect()
    want = {(d["doc_id"], i["item_id"]) for i in items for d in rows if f" {' '.join(split(i['text']))} " in f" {' '.join(split(d['text']))} "}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert want and len(want & got) >= 0.9 * len(want) and len(got - want) <= 0.1 * len(want)
    assert docs.count() - decontaminate.drop_leaks(docs, bench).count() == len({d for d, _ in got})


def planted(spark, docs, replaced, seed=3):
    """Items of the smallest benchmark, each with a share of its words replaced, inside words of a document."""
    rng = np.random.default_rng(seed)
    around = [w for r in docs.select("text").dropna().collect() for w in split(r["text"])]
    rows = []
    for i in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        words = split(i["text"])
        other = [f"{w}x{k}" if rng.random() < replaced else w for k, w in enumerate(words)]
        at, size = int(rng.integers(0, len(around) - 700)), int(rng.integers(100, 350))
        rows.append((100_000 + i["item_id"], " ".join(around[at:at + size] + other + around[at + size:at + 2 * size])))
    return spark.createDataFrame(rows, "doc_id long, text string")


def brute(rows, bench, idf, s):
    """(doc_id, item_id) that the subsequence rule accepts anywhere in a document."""
    want = set()
    bins = lambda w: (w >> np.uint64(64 - s.bits)).astype(np.int64)
    for i in bench.collect():
        item, _ = hash_words(pa.array([i["text"]]))
        w = idf[bins(item)].astype(np.float64) + 1e-6
        tail = slice(-max(1, len(item) // 4), None)
        for doc, text in rows:
            words, _ = hash_words(pa.array([text]))
            for k in range(0, max(1, len(words) - len(item)), 8):
                region = words[k:k + 2 * len(item)]
                if w[np.isin(item, region)].sum() >= s.loose * w.sum() and (share := decontaminate.common_weight(item, w, region) / w.sum()) >= s.loose and (
                        share >= s.direct or decontaminate.common_weight(item[tail], w[tail], region) >= s.answer * w[tail].sum()):
                    want.add((doc, i["item_id"]))
                    break
    return want


@pytest.mark.parametrize("replaced", [0.2, 0.3])
def test_leak_recall_of_paraphrases(spark, docs, replaced):
    s = decontaminate.Settings()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    everything = docs.select("doc_id", "text").filter("doc_id < 20").unionByName(planted(spark, docs, replaced))
    rows = [(r["doc_id"], r["text"]) for r in everything.collect()]
    want = brute(rows, bench, decontaminate.inverse_frequencies(everything, s), s)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(everything, bench).collect()}
    assert len([d for d, _ in want if d and d >= 100_000]) >= 10 and want <= got


@pytest.mark.parametrize("length", [5, 12, 60, 150, 300])
def test_verbatim_recall_by_length(spark, docs, length):
    """256 items of one length in 64 documents, beginning anywhere in a block."""
    rng = np.random.default_rng(length)
    common = [w for r in docs.filter("doc_id < 20").select("text").dropna().collect() for w in split(r["text"])]
    items = [" ".join(common[int(rng.integers(len(common)))] if rng.random() < 0.5 else f"rare{k}x{j}" for j in range(length)) for k in range(256)]
    texts = []
    for k in range(0, 256, 4):
        parts = [" ".join(common[at:at + int(rng.integers(20, 90))]) for at in rng.integers(0, len(common) - 100, 5)]
        texts.append((k, " ".join(x for pair in zip(parts, [*items[k:k + 4], ""], strict=True) for x in pair)))
    own = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(own, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert {(k - k % 4, k) for k in range(256)} <= got


def test_pieces_return_every_text(docs, empty):
    for settings in (pieces.Settings(), pieces.Settings(chunk=300, fan=3)):
        encoded = pieces.encode_documents(docs, settings=settings)
        got = pieces.decode_documents(encoded)
        assert Counter((r["doc_id"], r["text"], r["n_tokens"]) for r in got.collect()) == Counter(
            (r["doc_id"], r["text"] or "", len(r["ids"])) for r in docs.join(encoded.select("doc_id", "text_hash", "ids").distinct(), docs["doc_id"].eqNullSafe(encoded["doc_id"])).select(docs["doc_id"], "text", "ids").collect())
    assert pieces.encode_documents(empty).count() == 0


def test_pieces_are_the_best_path(local):
    """Equal in weight to SentencePiece's own lattice over the same pieces and weights, in chunks too."""
    pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    model = pieces.Model(pieces.default_path())
    proto = pb2.ModelProto()
    with open(pieces.default_path(), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for i, w in model.weights.items():
        proto.pieces[i].score = w / (1 << 20)
    other, encoder = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString()), pieces.Encoder(model, 1000)
    weight = lambda ids: sum(model.weights.get(i, 0) for i in ids)
    for text in [t for _, t in local[:80] if t and len(t) < 5000] + ["x" * 500, "a  b   c\n\n d ", "日本語テキスト xx"]:
        ids = encoder.text(text)
        assert abs(weight(ids) - weight(other.encode(text))) <= 64 and len(ids) == len(other.encode(text))
        full = pieces.normalised(text)
        parts = [(full[a:a + 50], full[a + 50:a + 50 + model.longest - 1]) for a in range(0, len(full), 50)]
        matrices = [pieces.transfer(model, encoder, *p) for p in parts]
        states = pieces._states(matrices, 0, 0)
        joined = [i for p, a, b in zip(parts, states, states[1:], strict=False) for i in pieces.chunk_ids(model, encoder, *p, a, b)]
        total = matrices[0]
        for m in matrices[1:]:
            total = pieces.combine(total, m)
        assert weight(joined) == weight(ids) and b"".join(model.spelled[i] for i in joined) == f" {text}".encode() and total[0, 0] <= weight(ids)


def test_katz_base_score_and_normalisation(spark, docs, local):
    rows = docs.select("doc_id", "text", (F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))).alias("held_out"))
    model = katz.train_katz(rows)
    got = [r.asDict() for r in katz.score_katz(rows, model).collect()]
    held = {(r["doc_id"]): r["held_out"] for r in rows.collect()}
    c = Counter()
    for i, t in local:
        if not held[i]:
            c.update([*split(t), None])
    n, v = sum(c.values()), len(c)
    want = Counter((i, len(split(t)) + 1, sum(w in c for w in [*split(t), None]), n) for i, t in local)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got) == want
    base = {i: sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*split(t), None]) for i, t in local}
    assert all(r["base_score"] == pytest.approx(base[r["doc_id"]], rel=1e-9) for r in got)
    # every context's probabilities, over the known words and the unknown class, sum to one
    value = {r["key"]: r["value"] for r in model.table.collect()}
    number = {w: katz.END if w is None else hash_words(pa.array([w]))[0][0] for w in c}
    signed = lambda x: int(np.uint64(x).astype(np.int64))
    plain = _unigrams(c, n, katz.Settings())
    for context in (split(local[0][1])[0], split(local[3][1])[2], "the"):
        back = value[signed(number[context])] - math.log10(plain[context])
        total = 10 ** (model.unknown + back)
        for w, p in plain.items():
            pair = katz._ngrams(np.array([number[context], number[w]], dtype=np.uint64), np.zeros(2, dtype=int), 2)[0][0]
            total += 10 ** (math.log10(p) + back + value.get(signed(pair), 0.0))
        assert total == pytest.approx(1.0, abs=1e-6)


def _unigrams(c, n, s):
    times = Counter(min(x, s.discounted + 2) for x in c.values())
    cut = katz.discounts({r: times.get(r, 0) for r in range(1, s.discounted + 2)}, s)
    return {w: cut.get(x, 1.0) * x / n for w, x in c.items()}


def test_katz_beats_the_base_and_handles_empty(docs, empty):
    rows = katz.with_held_out(docs)
    total = katz.score_katz(rows, katz.train_katz(rows)).filter("NOT held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert total[0] > total[1]
    three = katz.Settings(order=3)
    assert katz.score_katz(rows, katz.train_katz(rows, three), three).filter("score IS NULL OR score > 0").count() == 0
    none = katz.train_katz(katz.with_held_out(empty))
    assert katz.score_katz(rows, none).filter("score IS NULL").count() == 0


def test_passage_quality(docs, labels):
    model = passages.train_on(docs, labels)
    got = passages.score_quality(docs.drop("score"), model)
    assert got.count() == docs.count() and got.filter("score IS NULL OR isnan(score)").count() == 0
    held = got.filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).join(labels.dropna().dropDuplicates(["doc_id"]), "doc_id")
    assert held.filter((F.col("score") >= 0.3) != (F.col("quality") == 1)).count() <= 0.2 * held.count()
    assert passages.score_quality(docs.drop("score"), None).filter("score <> 0.5").count() == 0


def test_attention_gradients():
    s = passages.Settings(hidden=3, projected=2)
    r = np.random.default_rng(0)
    w = passages.width(s)
    p = {"V": r.normal(size=(w, 3)), "U": r.normal(size=(w, 3)), "w": r.normal(size=3), "c": r.normal(size=w), "b": r.normal(size=1)}
    x, ends, y = r.normal(size=(7, w)), np.array([0, 3, 7]), np.array([1.0, 0.0])
    loss = lambda: -float(np.mean(y * np.log(q := passages._forward(p, x, ends)[-1]) + (1 - y) * np.log(1 - q)))
    g = passages._gradients(p, x, ends, y)
    for name, at in (("V", (2, 1)), ("U", (4, 0)), ("w", (1,)), ("c", (3,)), ("b", (0,))):
        p[name][at] += 1e-6
        up = loss()
        p[name][at] -= 2e-6
        down = loss()
        p[name][at] += 1e-6
        assert g[name][at] == pytest.approx((up - down) / 2e-6, abs=2e-4)


def test_chat_parts_and_digests(spark):
    text = "<|im_end|>\\<|im_start|>\n\\n"
    parts = [("text", text, None, None), ("image", None, "s3://a", 784 * 3 + 1), ("text", "mid", None, None), ("audio", None, "b", None), ("document", None, None, 9)]
    rows = [(1, 0, "us\ner", parts), (1, 1, "assistant", [("text", text, None, None)]), (1, 1, "assistant", [("text", None, None, None)]), (None, 0, None, None), (2, 0, "assistant", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    formatted = chat.format_turns(df)
    first = formatted.filter("conv_id = 1 AND turn = 0").first()
    assert [tuple(a) for a in first["attachments"]] == [(1, "image", "s3://a", 4), (2, "audio", "b", 1), (3, "document", None, 3)]
    assert re.findall(r"<\|(\w+)\|>", first["formatted"]) == ["im_start", "line", "image", "audio", "document", "im_end"]
    back = chat.read_back(formatted)
    assert {r["text"] for r in back.filter("role = 'assistant'").collect()} == {text, ""} and back.filter("conv_id = 1 AND turn = 0").first()["role"] == "us\ner"
    got = {r["conv_id"]: r for r in chat.digests(back).collect()}
    assert set(got) == {1, 2, None} and got[1]["n_turns"] == 3 and got[1]["loss_chars"] == len(text)
    assert got[1]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[2]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    with pytest.raises(Exception, match="unknown kind"):
        chat.format_turns(spark.createDataFrame([(1, 0, "u", [("video", None, None, None)])], df.schema)).collect()
    assert chat.digests(chat.read_back(chat.format_turns(df.limit(0)))).count() == 0


def test_main_text(spark):
    page = ("<body><div id=menu><a href=x>Home</a></div><div class='cookie-notice'>We use cookies on this site.</div><main><h1>T &lt;i&gt;</h1><p>Some  text<b> here</b> &amp; "
            "more.</p><div class=comments><p>Nice post by me which is long enough really</p></div><p>End.</p></main><aside>x</aside>")
    assert html.main_text(page) == "T <i>\nSome text here & more.\nEnd."
    body = "".join(f"<p>Sentence number {k} of a long enough paragraph, with words.</p>" for k in range(5))
    assert html.main_text(f"<div class=nav><a>a</a></div>{body}<form>Name <input></form><script>'</p>'</script>").count("\n") == 4
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>short"), (3, "u", "<p>short"), (None, "u", "<article><p>unclosed <!-- x")]
    got = html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)))
    assert sorted(r["text"] for r in got.collect()) == ["", "", "short", "short", "unclosed"]
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    import html as decoder
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S).group(1)
        blocks = [" ".join(decoder.unescape(re.sub(r"<[^>]*>", " ", p.replace("<b>", ""))).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        want[r["page_id"]] = "\n".join(filter(None, blocks))
    assert {r["page_id"]: r["text"] for r in html.extract_main_text(pages).collect()} == want


def test_main_text_keeps_the_whole_article():
    long = "".join(f"<p>Sentence number {k} of a long enough paragraph, with words.</p>" for k in range(150))
    want = [f"Sentence number {k} of a long enough paragraph, with words." for k in range(150)]
    box = "<aside><p>a</p><p>b</p><p>c</p><p>d</p></aside>"
    last = "Closing words. " * 20
    page = f"<body><article>{long}{box}<p>{last}</p><ul><li><a href=x>A linked reference</a></li></ul><div class=share><p>x</p><p>y</p><p>z</p><p>w</p></div><p>The end.</p></article>"
    assert html.main_text(page).split("\n") == [*want, last.strip(), "A linked reference", "The end."]
    plain = "".join(f"<p>Sentence number {k} of a long enough paragraph, with words.</p>" for k in range(5))
    linked = "<ul><li><a href=x>A</a></li><li><a href=x>B</a></li><li><a href=x>C</a></li></ul>"
    assert html.main_text(f"<ul><li><a href=x>Home</a></li></ul>{plain}{linked}{plain}").split("\n") == [*want[:5], "A", "B", "C", *want[:5]]


def test_main_text_inside_wrappers():
    nav, aside = "<div class='site-nav'><p>menu</p></div>", "<aside><article><p>Teaser.</p></article></aside>"
    for wrapper in ("class='content-with-sidebar'", "id=page-no-header", "class='x has-comments'", "class=sidebar", "role=banner"):
        assert html.main_text(f"<body>{nav}{aside}<div {wrapper}><main><p>The article itself.</p></main></div><p>out</p>") == "The article itself."
        assert html.main_text(f"<body>{nav}<div {wrapper}><main><p>The article itself.</p></main></div><p>out</p>") == "The article itself."
        assert html.main_text(f"<body>{nav}<div {wrapper}><p>The text of a page without a mark.</p></div>") == "The text of a page without a mark."
    comments = "<div id=comments>" + "<article class=comment><p>A long comment by a reader.</p></article>" * 9 + "</div>"
    assert html.main_text(f"<main><article><p>Short post.</p></article>{comments}</main>") == "Short post."
    assert html.main_text("<article><p>we ask if 1 < 2</p><p>and if 3 < 5 then go on") == "we ask if 1 < 2\nand if 3 < 5 then go on"
    assert html.main_text("<article><p>cut within a tag <a href='x") == "cut within a tag"


def test_feistel_is_a_permutation():
    for total in (1, 2, 5, 64, 1000, 4097):
        assert sorted(shards.slots(np.arange(total), total, 3, 6).tolist()) == list(range(total))
    assert shards.slots(np.arange(1000), 1000, 3, 6).tolist() != shards.slots(np.arange(1000), 1000, 4, 6).tolist()


def test_shards_hold_every_token_in_order(spark, docs, tmp_path, empty):
    s = shards.Settings(length=32, per_shard=500)
    path = str(tmp_path / "docs")
    docs.select("doc_id", "text").write.parquet(path)
    manifest = shards.training_order(spark.read.parquet(path), f"file://{tmp_path}/shards", settings=s)
    rows = sorted((r["slot"], r["doc_id"], r["part"], r["n_tokens"], r["stored"], r["shard"], r["offset"]) for r in manifest.collect())
    assert [r[0] for r in rows] == list(range(len(rows))) and all(r[4] and r[5] == r[0] // 500 and r[6] == r[0] % 500 * 64 for r in rows)
    records = list(shards.read_from(f"{tmp_path}/shards", 0, s))
    assert len(records) == len(rows) and all((a == b).all() for a, b in zip(shards.read_from(f"{tmp_path}/shards", 700, s), records[700:], strict=True))
    texts = defaultdict(dict)
    for slot, doc, part, n, *_ in rows:
        texts[doc][part] = records[slot][:n].tolist()
    ranks, pattern = shards._ranks(None)
    encoding = shards.Tokenizer(ranks, pattern, 10).encoding
    for r in docs.dropDuplicates(["doc_id"]).collect():
        assert encoding.decode([i for k in sorted(texts[r["doc_id"]]) for i in texts[r["doc_id"]][k]]) == (r["text"] or "")
        assert [i for k in sorted(texts[r["doc_id"]]) for i in texts[r["doc_id"]][k]] == encoding.encode_ordinary(r["text"] or "")
    empty_path = str(tmp_path / "none")
    empty.select("doc_id", "text").write.parquet(empty_path)
    assert shards.training_order(spark.read.parquet(empty_path), f"file://{tmp_path}/none-shards", settings=s).count() == 0


def test_pipeline_stages(spark, docs, labels, tmp_path):
    import corpus_pipeline

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert 0 < out.count() < docs.count() and len(corpus_pipeline.STAGES) == 5
