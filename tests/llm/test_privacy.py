"""Personal data: patterns against plain regular expressions, the network against numeric gradients
and exhaustive decoding, windows against their joints, and held-out spans."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.llm import privacy, queries

SCHEMA = "doc_id long, text string, lang string, score double"
TINY = privacy.Settings(hidden=3, width=20, updates=5, batch=4)


def plain_luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and plain_luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_patterns():
    rng = random.Random(5)
    texts = ["a@b.c@d.e", "x@y", "@a.b", "a@b..c", "1.2.3.4.5.6.7.8", "300.1.2.3", "4111 1111-1111 1111", "+1 (325) 555-8094.", "+1+2 345 678 901", "é@a.b", "a.b%c+d-e@f-g.h-i.jk", "0001.0255.00.9",
             "+12 ", "ab@cd.ef@gh.ij"]
    texts += ["".join(rng.choice("a1.@+- (é0259") for _ in range(60)) for _ in range(3000)]
    for text in texts:
        assert privacy.base_spans(text) == plain(text), text
    assert privacy.base_spans("9" * 5000 + ".1.1.1 " + "a" * 100_000 + " " + "." * 100_000 + "@" * 1000) == []


def windows(seed, lanes):
    rng = np.random.default_rng(seed)
    chars, tags = rng.integers(0, privacy.CLASSES, (9, lanes)), np.zeros((9, lanes), dtype=np.int64)
    tags[2, 0], tags[3:5, 0], tags[6, 1] = 3, 4, 7
    return chars, tags


def test_gradients():
    w, (chars, tags) = privacy.new_weights(TINY), windows(1, 4)
    rng = np.random.default_rng(2)
    w["step"] = rng.normal(0, 0.5, w["step"].shape)
    _, g = privacy.loss_and_gradient(w, chars, tags)
    for name, v in w.items():
        for at in [tuple(rng.integers(0, n) for n in v.shape) for _ in range(6)] + [(int(chars[2, 0]), 4)] * (name[:2] == "in"):
            kept, tiny = v[at], 1e-5
            if name == "step" and not privacy.transitions_allowed()[at]:
                continue
            v[at] = kept + tiny
            up = privacy.loss_and_gradient(w, chars, tags)[0]
            v[at] = kept - tiny
            down = privacy.loss_and_gradient(w, chars, tags)[0]
            v[at] = kept
            assert abs((up - down) / (2 * tiny) - g[name][at]) < 1e-6, name


def test_decoding_is_exhaustive_search():
    rng = np.random.default_rng(4)
    ok = privacy.transitions_allowed()
    for turn in range(30):
        step = rng.normal(0, 1, (9, 9)).astype(np.float32)
        scores = rng.normal(-1.5 * (turn % 2), 1, (4, 1, 9)).astype(np.float32)
        paths = [p for p in itertools.product(range(9), repeat=4) if ok[0, p[0]] and all(ok[a, b] for a, b in zip(p, p[1:]))]
        value = lambda p: sum(scores[t, 0, x] for t, x in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:]))
        best = max(paths, key=value)
        got = privacy.viterbi(scores, np.where(ok, step, np.float32(-1e9)))[:, 0]
        assert abs(value(tuple(got)) - value(best)) < 1e-4
        if any(best):
            assert privacy.best_single_span(scores.transpose(0, 2, 1), step)[0] > -1e-4  # never left out wrongly


def test_both_passes_give_the_same_states():
    w, (chars, _) = privacy.new_weights(TINY), windows(3, 6)
    want = privacy.lstm(chars, w["in_f"], w["rec_f"]) @ w["out"][:3]
    assert np.allclose(privacy.states_of(chars, w["in_f"], w["rec_f"], w["out"][:3]).transpose(0, 2, 1), want, atol=1e-5)


def test_spans_are_reconciled():
    text = "x" * 300
    keep = lambda found, base=(): privacy.reconcile(text, found, list(base), 1.0)
    digits = "0" * 300
    two = [(3, 90, 100, 5.0, False, True), (3, 90, 104, 7.0, False, False), (3, 92, 104, 6.0, True, False)]
    assert privacy.reconcile(digits, [(3, 90, 100, 5.0, False, True), (3, 94, 104, 7.0, True, False)], [], 1.0) == [(3, 90, 104)]
    assert privacy.reconcile(digits, two, [], 1.0) == [(3, 90, 104)]
    assert privacy.reconcile(digits, two, [(2, 100, 116)], 1.0) == [(2, 100, 116)]  # patterns go first
    assert privacy.reconcile(digits, [(3, 0, 10, 2.0, False, False), (3, 20, 30, 2.0, False, False), (2, 8, 24, 3.5, False, False)], [], 1.0) == [(3, 0, 10), (3, 20, 30)]
    assert privacy.reconcile(digits, [(2, 8, 24, 3.5, False, False)], [], 4.0) == [] and keep([(3, 1, 9, 9.0, False, False)]) == []


@pytest.fixture(scope="module")
def model():
    rng, windows_ = random.Random(8), []
    names = "the a of and river stone walks into green under while mat that dot".split()
    for k in range(240):
        say = lambda n: " ".join(rng.choice(names) for _ in range(n))
        digits = "".join(rng.choice("0123456789") for _ in range(10))
        what = [(0, f"jo.{digits[:2]}@mail{digits[2]}.example.com"), (0, f"jo.{digits[:2]} at mail{digits[2]} dot example dot com"), (3, f"+1 ({digits[:3]}) 555-{digits[3:7]}"),
                (3, f"({digits[:3]}) 555-{digits[3:7]}"), None][k % 5]
        lead = say(4) + " "
        text = lead + (what[1] if what else say(3)) + " " + say(3)
        windows_.append((text[:96], [(what[0], len(lead), len(lead) + len(what[1]))] if what and len(lead) + len(what[1]) <= 96 else []))
    return privacy.learn(windows_, privacy.Settings(updates=160, batch=32))


def test_other_spellings_are_found(model):
    found = lambda t: privacy.spelled(privacy.add_spans([t], model, privacy.Settings(margin=3.0))[0][1])
    text = "green stone walks into jo.55 at mail3 dot example dot com under the river"
    assert found(text) == "email:23:57"
    assert found("the mat walks under the stone and the river that walks into a green mat") == ""
    # the same span everywhere round the joint of two windows, in a text of many windows
    s = privacy.Settings(margin=3.0)
    filler = "the green river walks under a stone and " * 60
    for at in range(360, 460, 9):
        long = filler[:at].rstrip() + " " + "jo.55 at mail3 dot example dot com" + " " + filler[at:at + 700].lstrip()
        start = long.index("jo.55")
        assert privacy.spelled(privacy.add_spans([long], model, s)[0][1]) == f"email:{start}:{start + 34}"


def test_query(spark, model):
    queries.reachable(spark)
    own = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", F.lit(0.5).alias("score"))
    odd = [(9001, None, None, None), (9002, "", "en", 1.0), (None, "mail jo@x.org", "en", 1.0), (9003, "jo@x.org " * 40_000, "en", 1.0), (9003, "é +1 (325) 555-8094", "en", 1.0), (9003, "é +1 (325) 555-8094", "en", 1.0)]
    docs = own.unionByName(spark.createDataFrame(odd, SCHEMA))
    for weights in (model, None):
        rows = privacy.find_private(docs, weights).collect()
        assert len(rows) == docs.count()
        for r in rows:
            want = plain(r["text"] or "")
            assert [r[f"n_{k}"] for k in privacy.KINDS] == [sum(x[0] == k for x in want) for k in range(4)]
            text = privacy.spelled(want)
            assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
            assert set(filter(None, text.split(","))) <= set(r["spans"].split(",")) and (weights or r["spans"] == text)
    with pytest.raises(ValueError, match="spans"):
        privacy.find_private(docs.withColumnRenamed("lang", "Spans"), None)


def test_without_rows(spark):
    queries.reachable(spark)
    empty = spark.createDataFrame([], SCHEMA)
    assert privacy.fit(empty) is None and privacy.find_private(empty, None).count() == 0
    assert privacy.fit(spark.createDataFrame([(1, "nothing here", "en", 1.0), (2, None, None, None)], SCHEMA)) is None
    sample = privacy.training_windows(spark.createDataFrame([(k, f"call +1 (325) 555-{8000 + k} now", "en", 1.0) for k in range(50)], SCHEMA), privacy.Settings(sample_windows=7))
    assert sample.filter("size(kinds) = 1").count() == 7


def test_texts_are_searched_once_for_training_windows(spark, monkeypatch):
    queries.reachable(spark)
    tables, staged = [], privacy.staged
    monkeypatch.setattr(privacy, "staged", lambda df, name: tables.append(staged(df, name)) or tables[-1])
    assert privacy.fit(spark.createDataFrame([(k, f"call +1 (325) 555-{8000 + k} now", "en", 1.0) for k in range(50)], SCHEMA), privacy.Settings(hidden=3, updates=5, batch=4))
    assert len(tables) == 1
    at = spark._jvm.org.apache.hadoop.fs.Path(tables[0].inputFiles()[0])
    assert not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
