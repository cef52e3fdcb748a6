"""Links through rows without an id, pages without the end of their head, comments as articles, clashing names, order of shards."""

from __future__ import annotations

import numpy as np

from tidemark.llm import html, jaccard, passages, pieces, queries, shards, toxicity


def test_links_run_through_rows_without_an_id(spark):
    queries.reachable(spark)
    words = [f"w{k}" for k in range(66)]
    a, b, c = words[:56], words[5:61], words[10:66]
    rows = [(1, " ".join(a)), (None, " ".join(b)), (None, " ".join(b)), (3, " ".join(c)), (4, "quite another text with more than five words"), (None, "")]
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.join_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # 1 and 3 share 42 of 62 shingles, each 47 of 57 with the text between
    assert {(1, 1), (3, 1), (4, 4)} <= got


def test_head_without_its_end():
    body = "<article><h1>Title</h1><p>The first paragraph of the page, long enough to count.</p><p>And a second one that follows it.</p></article>"
    want = html.main_text(f"<html><head><title>x</title></head><body>{body}</body></html>")
    assert want.startswith("Title\n")
    script = "<script>var a = '<div>no</div>';</script>"
    for page in (f"<html><head><title>x</title>{script}<body>{body}</body></html>", f"<head><meta charset=utf-8><title>x</title>{body}", f"<head>{script}<title>x</title>\n{body}"):
        assert html.main_text(page) == want


def test_comments_as_articles():
    text = "<p>The first paragraph of the page, long enough to count as main text.</p>"
    inside = f"<body><article class='post'>{text}<article class='comment'><p>I disagree with all of this at length.</p></article><p>Last words.</p></article></body>"
    beside = f"<body><main><article>{text}<p>Last words.</p></article><article class='comment'><p>I disagree with all of this at length.</p></article></main></body>"
    for page in (inside, beside):
        assert html.main_text(page) == "The first paragraph of the page, long enough to count as main text.\nLast words."


def test_added_columns_leave_columns_of_their_name_alone(spark):
    queries.reachable(spark)
    docs = spark.createDataFrame([(1, "a b c", "mine", 7), (2, None, None, None)], "doc_id long, text string, Score string, _score int")
    model = (np.array([0], dtype=np.int64), np.array([0.25]))
    for got in (toxicity.score_toxicity(docs, model), toxicity.score_toxicity(docs, None), passages.score_quality(docs, None)):
        assert got.columns == [*docs.columns, "__score"]
        rows = {r[0]: r for r in got.collect()}
        assert rows[1][1:4] == ("a b c", "mine", 7) and rows[2][1:4] == (None, None, None) and 0 <= rows[2][4] <= 1
    encoded = pieces.encode_documents(docs.select("doc_id", "text")).selectExpr("*", "'mine' AS text")
    back = {r["doc_id"]: (r["text"], r["_text"]) for r in pieces.decode_documents(encoded).collect()}
    assert back == {1: ("mine", "a b c"), 2: ("mine", "")}


def test_slots_follow_the_order_in_which_documents_were_read(spark, tmp_path):
    queries.reachable(spark)
    s = shards.Settings(length=4, per_shard=8)
    texts = [None if k % 11 == 0 else "" if k % 7 == 0 else " ".join(f"word{k} and  more" for _ in range(k % 13)) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartitionByRange(5, "doc_id")
    stored = str(tmp_path / "docs.parquet")
    docs.write.parquet(stored)
    manifest = shards.training_order(spark.read.parquet(stored), f"file://{tmp_path}/shards", settings=s).collect()
    ranks, pattern = shards._ranks(None)
    encoding = shards.Tokenizer(ranks, pattern, 10).encoding
    cut = [(d, encoding.encode_ordinary(t or "")) for d, t in enumerate(texts)]
    want = {(d, part): ids[part * 4:part * 4 + 4] for d, ids in cut for part in range(-(-len(ids) // 4))}
    assert {(r["doc_id"], r["part"]) for r in manifest} == set(want) and len(manifest) == len(want) and all(r["stored"] for r in manifest)
    records = list(shards.read_from(f"{tmp_path}/shards", 0, s))
    for r in manifest:
        ids = want[r["doc_id"], r["part"]]
        assert r["n_tokens"] == len(ids) and records[r["slot"]].tolist() == ids + [shards.END_ID] * (4 - len(ids))
    slots = shards.slots(np.arange(len(want)), len(want), s.key, s.rounds).tolist()
    assert sorted(r["slot"] for r in manifest) == sorted(slots) == list(range(len(want)))
    at = {r["slot"]: (r["doc_id"], r["part"]) for r in manifest}
    parts = [at[x] for x in slots]  # by sequence number: the parts of a document are neighbours in order
    assert all(b == (a[0], a[1] + 1) or (b[1] == 0 and (a[0], a[1] + 1) not in want) for a, b in zip(parts, parts[1:]))
