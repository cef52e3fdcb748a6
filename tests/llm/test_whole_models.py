"""Models that keep all of what they count."""

from __future__ import annotations

import numpy as np

from tidemark.llm import katz, queries
from tidemark.llm.words import hash_words


def test_bigrams_met_once_are_in_the_model(spark):
    import pyarrow as pa

    queries.reachable(spark)
    rows = spark.createDataFrame([(1, "alpha beta gamma", False), (2, "beta delta", False), (3, "alpha beta", True)], "doc_id long, text string, held_out boolean")
    model = katz.train_katz(rows)
    keys = {r["key"] for r in model.table.select("key").collect()}
    words, _ = hash_words(pa.array(["alpha beta gamma"]))
    once = katz._ngrams(np.concatenate([[katz.BEGIN], words, [katz.END]]), np.zeros(5, dtype=int), 2)[0]
    assert {int(k) for k in once.view(np.int64)} <= keys
    score = {r["doc_id"]: r["score"] for r in katz.score_katz(rows, model).collect()}
    assert score[1] > katz.score_katz(rows, katz.train_katz(rows.filter("doc_id = 2"))).filter("doc_id = 1").first()["score"]


def test_shards_are_dealt_in_passes_without_loss(spark, tmp_path, monkeypatch):
    from tidemark.llm import shards

    queries.reachable(spark)
    path = f"{tmp_path}/docs"
    spark.createDataFrame([(k, f"some words {k} " * (k % 7)) for k in range(40)], "doc_id long, text string").write.parquet(path)
    staged, tables = shards.staged, []
    monkeypatch.setattr(shards, "staged", lambda df, name: tables.append(staged(df, name)) or tables[-1])
    s = shards.Settings(length=4, per_shard=8)
    rows = shards.training_order(spark.read.parquet(path), f"file://{tmp_path}/shards", settings=s).collect()
    assert len(tables) == 2  # each shuffle holds half of the shards at most
    halves = [{r["shard"] for r in t.collect()} for t in tables]
    assert max(halves[0]) + 1 == min(halves[1]) and abs(len(halves[0]) - len(halves[1])) <= 1
    assert sorted(r["slot"] for r in rows) == list(range(len(rows))) and all(r["stored"] for r in rows)
    assert len(list(shards.read_from(f"{tmp_path}/shards", 0, s))) == len(rows)
