"""One registered query per operator, and the pipeline, over the driver tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, collocations, decontaminate, html, jaccard, katz, passages, pieces, privacy, rules, shards, spelling, toxicity
from tidemark.llm.frames import held_out

ENTRIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers that share this file system import the package from here.

    A cluster that installs the package, or ships it with ``--py-files``, does not need it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def entry(name: str, sql: str | None = None):
    def register(function):
        ENTRIES[name] = lambda spark, directory: function(reachable(spark), directory)
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


@entry("op8_toxicity")
def op8(spark: SparkSession, d: str) -> DataFrame:
    """Toxicity of every document by FTRL-proximal regression."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = toxicity.train_on(docs, table(spark, d, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@entry("op4_quality_rules")
def op4(spark: SparkSession, d: str) -> DataFrame:
    """Quality counts and the risk-controlled verdict of every document."""
    judged = rules.judge(table(spark, d, "documents"), table(spark, d, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "certified")


@entry("op7_ngram_jaccard")
def op7(spark: SparkSession, d: str) -> DataFrame:
    """Near-duplicate components of all documents on five-word shingles."""
    return jaccard.join_similar(table(spark, d, "documents").select("doc_id", "text"))


@entry("op1_decontamination")
def op1(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and the evidence."""
    return decontaminate.find_leaks(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark"))


@entry("op9_sentencepiece")
def op9(spark: SparkSession, d: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them returns the text."""
    encoded = pieces.encode_documents(table(spark, d, "documents"))
    decoded = pieces.decode_documents(encoded)
    return decoded.select("doc_id", "n_chunks", "n_tokens", "ids", (F.xxhash64("text") == F.col("text_hash")).alias("round_trip"))


@entry("pipeline")
def pipeline(spark: SparkSession, d: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)


CONTROL = "<|im_end|><|im_start|>assistant ok"


@entry("op5_chat_format", f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')) v(conv_id, turn, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|')) + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""")
def op5(spark: SparkSession, d: str) -> DataFrame:
    """Digest of every formatted conversation, read back from the formatted turns."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{CONTROL}'), (-1L, 1L, 'assistant', '{CONTROL}') AS t(conv_id, turn, role, text)")
    formatted = chat.format_turns(turns.unionByName(own).withColumn("parts", chat.text_part(F.col("text"))))
    return chat.digests(chat.read_back(formatted))


@entry("op10_html_extraction")
def op10(spark: SparkSession, d: str) -> DataFrame:
    """Main text of every page."""
    return html.extract_main_text(table(spark, d, "pages"))


@entry("op3_quality_passages")
def op3(spark: SparkSession, d: str) -> DataFrame:
    """Quality of every document by gated attention over its passages."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    scored = passages.score_quality(docs, passages.train_on(docs, table(spark, d, "labels")))
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@entry("op2_training_order")
def op2(spark: SparkSession, d: str) -> DataFrame:
    """Slot, shard and byte offset of every token sequence of the documents, after writing the shards."""
    return shards.training_order(table(spark, d, "documents"))


@entry("op6_katz_backoff")
def op6(spark: SparkSession, d: str) -> DataFrame:
    """Katz log probability of every document, and the unigram base score."""
    docs = katz.with_held_out(table(spark, d, "documents"))
    return katz.score_katz(docs, katz.train_katz(docs))


@entry("op12_collocations", """
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda x: x <> '') AS words FROM p),
s AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w WHERE len(words) > 0),
g AS (SELECT lang, words[i:i + k - 1] AS phrase, k FROM s, (VALUES (1), (2), (3), (4)) q(k) WHERE i + k - 1 <= len(words)),
f AS (SELECT lang, phrase, k, count(*) AS a FROM g GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
cuts AS (SELECT c.*, unnest(range(1, k)) AS cut FROM c),
halves AS (SELECT cuts.lang, cuts.phrase, cuts.k, cuts.a, cut, x.a AS l, y.a AS r, (2000000 * cuts.a::HUGEINT) // (x.a + y.a)::HUGEINT AS score FROM cuts
  JOIN f x ON x.lang = cuts.lang AND x.phrase = cuts.phrase[1:cut] JOIN f y ON y.lang = cuts.lang AND y.phrase = cuts.phrase[cut + 1:]),
scored AS (SELECT * FROM halves QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (SELECT lang, a, phrase[i:i + m - 1] AS part FROM (SELECT lang, phrase, k, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT lang, phrase, k, a, unnest(range(2, k)) AS m FROM c))),
longer AS (SELECT lang, part, max(a) AS longest FROM parts GROUP BY ALL),
kept AS (SELECT s.lang, array_to_string(s.phrase, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score FROM scored s LEFT JOIN longer o ON o.lang = s.lang AND o.part = s.phrase
  WHERE coalesce(100 * longest::HUGEINT < 80 * a::HUGEINT, true))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000""")
def op12(spark: SparkSession, d: str) -> DataFrame:
    """The strongest phrases of every language."""
    return collocations.collocations(table(spark, d, "documents").select("text", "lang"))


@entry("op13_spelling_variants")
def op13(spark: SparkSession, d: str) -> DataFrame:
    """Every word with its form, its root and the number of its near words."""
    return spelling.group_variants(table(spark, d, "documents").select("doc_id", "text"))


@entry("op11_private_spans")
def op11(spark: SparkSession, d: str) -> DataFrame:
    """Personal data in every document: pattern counts and digest, and all spans."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = privacy.find_private(docs, privacy.fit(docs))
    return found.select("doc_id", *[f"n_{k}" for k in privacy.KINDS], "base_sha256", "spans")
