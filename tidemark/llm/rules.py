"""Quality rules with cutoffs whose false rejections are bounded (DataFrame functions only).

Every text is measured once. The texts that people marked good are split by a hash of their id.
A fifth of them, all strata together, orders the cutoffs: the level of a measured value is the
share of these texts that are as bad or worse, in steps of 1 / ``levels``, and a text's level is
the least over its measures. Rejecting every text up to a level is one joint cutoff of all rules.
The other good texts are the holdout: in each stratum (language) joint cutoffs are tried from the
laxest level up, and the walk ends at the first whose exact one-sided binomial bound on the share
of good texts it rejects is over ``alpha`` (fixed-sequence testing). The union of the rules is
certified at once, so only the strata need a correction, which is Bonferroni's. Hence, with
probability 1 - ``delta`` over the holdout, no stratum loses more than ``alpha`` of its good texts.
The number of strata is not limited: cutoffs are joined to the texts.

Defined cases: null text counts as empty; a null stratum is a stratum of its own; a stratum with
too few labels for any bound gets no cutoff and is marked so; labels without a document, or with null values, do
not count, and a document labelled twice counts with the smaller label; repeated rows are judged
each; other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import fresh, staged

SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    """``alpha``: good texts a stratum may lose; ``delta``: chance that the promise fails; ``steps``:
    grid of a measure; one good text in ``path_of`` orders the cutoffs, the others certify."""

    alpha: float = 0.02
    delta: float = 0.05
    steps: int = 400
    levels: int = 2_000
    path_of: int = 5
    min_words: int = 20
    repeat_percent: int = 30
    window: int = 8


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_exclamations"]

#: Measures of a text, each a share from 0 to 1 where more is worse.
MEASURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "duplicate_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "exclamations": "n_exclamations / greatest(n_words, 1)",
}


def _removed(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def measure(docs: DataFrame, text: str = "text", settings: Settings = Settings(), names: dict[str, str] | None = None, row: str | None = None) -> DataFrame:
    """``docs`` with the counts of each text; ``names`` renames the added columns.

    ``row`` adds a row number under that name. A filter that reads it stays above this step: the
    optimizer would otherwise copy the whole computation into the filter, once per use.

    Intermediate arrays are columns of their own and are referred to twice in the next step,
    which keeps the optimizer from computing them again for every element.
    """
    names = names or {}
    own = [F.col(f"`{c}`") for c in docs.columns]
    added = COUNTS
    tmp = fresh([*docs.columns, *added, *names.values()], "m")
    t, size = F.coalesce(F.col(f"`{text}`"), F.lit("")), settings.window
    w, lines, h, s, p = (F.col(f"{tmp}_{k}") for k in ("w", "l", "h", "s", "p"))
    full = lambda x: F.length(x) > 0
    step = docs.select(
        *own, F.filter(F.split(t, SPACES), full).alias(f"{tmp}_w"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(f"{tmp}_l"),
        _removed(t, r"[#*$%&|<>]").alias(f"{tmp}_sym"), _removed(t, r"\p{Lu}").alias(f"{tmp}_cap"), _removed(t, "!").alias(f"{tmp}_exc"),
    )
    step = step.select(
        *own, F.col(f"{tmp}_sym"), F.col(f"{tmp}_cap"), F.col(f"{tmp}_exc"), F.size(w).cast("long").alias(f"{tmp}_n"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias(f"{tmp}_chars"),
        F.size(lines).cast("long").alias(f"{tmp}_nl"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(f"{tmp}_dup"),
        F.when(F.size(w) >= size, F.transform(w, lambda x: F.xxhash64(x))).alias(f"{tmp}_w"),
    )
    keep = [*own, *(F.col(f"{tmp}_{k}") for k in ("sym", "cap", "exc", "n", "chars", "nl", "dup"))]
    step = step.select(*keep, F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.xxhash64(F.slice(w, i, size))).alias(f"{tmp}_h"))
    step = step.select(*keep, F.when(
        F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias(f"{tmp}_s"))
    same = lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])
    step = step.select(*keep, F.sort_array(F.transform(F.filter(s, lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"])).alias(f"{tmp}_p"))
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - x, F.lit(size)))), F.lit(0), lambda a, x: a + x)
    values = dict(zip(added, [
        F.col(f"{tmp}_n"), F.col(f"{tmp}_chars"), F.col(f"{tmp}_sym"), F.col(f"{tmp}_dup"), F.coalesce(covered, F.lit(0)).cast("long"),
        F.col(f"{tmp}_nl"), F.col(f"{tmp}_cap"), F.col(f"{tmp}_exc")], strict=True))
    numbered = [F.monotonically_increasing_id().alias(row)] if row else []
    return step.select(*own, *(v.alias(names.get(k, k)) for k, v in values.items()), *numbered)


def base_failed(settings: Settings = Settings(), prefix: str = "") -> Column:
    n, r = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < settings.min_words) | (100 * r > settings.repeat_percent * n)


def _log_gamma(x: Column) -> Column:
    """Natural logarithm of gamma(x) for x >= 1 (Stirling's series after a shift by 8)."""
    y = x + 8
    shift = F.lit(0.0)
    for k in range(8):
        shift = shift + F.log(x + k)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """Logarithm of P(X <= k) for X binomial(n, p), k < n p: exact sum, largest term first.

    Terms shrink by a falling ratio, so the sum ends once they no longer count: the terms
    beyond 60 (sqrt(n p) + 1) are smaller than 1e-18 of the first.
    """
    top = _log_gamma(n + 1.0) - _log_gamma(k + 1.0) - _log_gamma(n - k + 1.0) + k * F.log(p) + (n - k) * F.log(1 - p)
    last = F.least(k, (60 * (F.sqrt(n * p) + 1))).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    def add(a, j):
        term = a["term"] * (k - j + 1) / (n - k + j) * (1 - p) / p
        return F.struct(term.alias("term"), (a["total"] + term).alias("total"))
    terms = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return top + F.log(F.aggregate(terms, start, add)["total"])


def _steps(settings: Settings, names: dict[str, str] | None = None) -> dict[str, Column]:
    """The grid step of every measure; a text is rejected by a rule beyond its cutoff step."""
    found = {}
    for rule, sql in MEASURES.items():
        for column, name in (names or {}).items():
            sql = sql.replace(column, f"`{name}`")
        found[rule] = F.ceil(F.least(F.lit(1.0), F.expr(sql)) * settings.steps).cast("int")
    return found


def _stratum(stratum: str) -> Column:
    return F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("\0"))


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(stratum, good, level, and per rule the last grid step kept) for every stratum with good texts.

    ``measured`` has doc_id, the stratum and the counts of :func:`measure`. ``level`` and the steps
    are null where no cutoff is certified. Good texts are counted per grid step before anything
    is ordered: the order sees ``steps`` rows per rule, the walk ``levels`` rows per stratum.
    """
    good = labels.select("doc_id", F.col("quality").cast("int").alias("q")).dropna().groupBy("doc_id").agg(F.min("q").alias("q")).filter("q = 1").select("doc_id")
    values = F.struct(*[v.alias(r) for r, v in _steps(settings).items()])
    ordering = F.pmod(F.xxhash64("doc_id"), F.lit(settings.path_of)) == 0
    held = staged(measured.filter(~base_failed(settings)).join(good, "doc_id").select(
        _stratum(stratum).alias("stratum"), ordering.alias("ordering"), values.alias("at")).select("stratum", "ordering", "at.*"), "good-texts")

    # per rule: level of each grid step seen among the ordering texts, from the share at or beyond it
    seen = held.filter("ordering").select(F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("step")) for r in MEASURES])).alias("r")).select(
        "r.*").groupBy("rule", "step").agg(F.count(F.lit(1)).alias("n"))
    worse, all_texts = Window.partitionBy("rule").orderBy(F.desc("step")), Window.partitionBy("rule")
    levels = seen.select("rule", "step", F.ceil(F.sum("n").over(worse) * settings.levels / F.sum("n").over(all_texts)).cast("int").alias("level"))
    found = {(r["rule"], r["step"]): r["level"] for r in levels.collect()}  # at most ``steps`` + 1 per rule
    path = {}
    for rule in MEASURES:
        dense, level = [], 0
        for step in range(settings.steps, -1, -1):  # a step between seen ones has the level of the next one seen
            level = found.get((rule, step), level)
            dense.append(level)
        path[rule] = F.lit(dense[::-1])

    tested = held.filter("NOT ordering").select("stratum", F.least(*[F.get(path[r], F.col(r)) for r in MEASURES]).alias("level")).groupBy("stratum", "level").agg(F.count(F.lit(1)).alias("n"))
    tested = staged(tested, "good-levels")
    number = max(1, tested.agg(F.count_distinct("stratum")).first()[0])
    own = Window.partitionBy("stratum")
    walk = tested.select(
        "stratum", "level", F.sum("n").over(own).cast("double").alias("n"), F.sum("n").over(own.orderBy("level")).cast("double").alias("k"))
    allowed, limit = math.log(settings.delta / number), F.lit(settings.alpha)
    fails = F.when(F.col("k") >= F.col("n") * limit, True).otherwise(log_binomial_tail(F.col("k"), F.col("n"), limit) > allowed)
    # the number rejected changes only at the levels seen, so the walk ends before the first of them that fails
    ends = walk.withColumn("fails", fails).groupBy("stratum").agg(F.max("n").alias("good"), (F.min(F.when(F.col("fails"), F.col("level"))) - 1).alias("last"))
    enough = F.col("good") * math.log1p(-settings.alpha) <= allowed  # even no rejection certifies nothing in a smaller stratum
    last = F.when(enough & (F.col("last") >= 0), F.col("last"))

    def kept_steps(rule: str) -> Column:
        """Levels fall with the steps: those beyond the certified level come first."""
        return F.when(F.col("level").isNotNull(), F.size(F.filter(path[rule], lambda x: x > F.col("level"))) - 1).alias(rule)

    return ends.select("stratum", F.col("good").cast("long").alias("good"), last.cast("int").alias("level")).select(
        "stratum", "good", "level", *[kept_steps(r) for r in MEASURES])


def verdict(df: DataFrame, table: DataFrame, stratum: str = "lang", settings: Settings = Settings(), name: str = "kept", prefix: str = "", certified: str | None = None) -> DataFrame:
    """``df`` with a boolean: neither base rule nor any certified cutoff rejects the text.

    ``certified`` names one more boolean: whether the text's stratum has certified cutoffs. The
    table is written first, so that the planner knows its size and broadcasts it only if small.
    """
    tmp = fresh([*df.columns, name], "cut")
    table = staged(table.filter("level IS NOT NULL").select(
        F.col("stratum").alias(f"{tmp}_s"), *[F.col(r).alias(f"{tmp}_{r}") for r in MEASURES]), "cutoffs")
    joined = df.join(table, _stratum(stratum) == F.col(f"{tmp}_s"), "left")
    rejected = base_failed(settings, prefix)
    for rule, step in _steps(settings, {c: f"{prefix}{c}" for c in COUNTS}).items():
        rejected = rejected | F.coalesce(step > F.col(f"{tmp}_{rule}"), F.lit(False))
    more = [F.col(f"{tmp}_s").isNotNull().alias(certified)] if certified else []
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != name], (~rejected).alias(name), *more)


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """Counts and verdict of every document: doc_id, stratum, the counts, base_failed, kept, certified."""
    measured = staged(measure(docs.select("doc_id", stratum, "text"), "text", settings).drop("text"), "quality-measures")
    table = cutoffs(measured, labels, stratum, settings)
    return verdict(measured.withColumn("base_failed", base_failed(settings)), table, stratum, settings, certified="certified")


def drop_rejected(docs: DataFrame, labels: DataFrame, stratum: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that every rule lets through, with their columns as they were."""
    measured = staged(measure(docs.select("doc_id", stratum, "text"), "text", settings).drop("text"), "quality-measures")
    table = cutoffs(measured, labels, stratum, settings)
    prefix, added = "q_", COUNTS
    while any(f"{prefix}{a}".lower() in {c.lower() for c in docs.columns} for a in [*added, "kept", "row"]):
        prefix = f"_{prefix}"
    measured = measure(docs, "text", settings, {a: f"{prefix}{a}" for a in added}, f"{prefix}row")
    judged = verdict(measured, table, stratum, settings, f"{prefix}kept", prefix)
    return judged.filter(f"`{prefix}kept` AND `{prefix}row` >= 0").select(*[F.col(f"`{c}`") for c in docs.columns])
