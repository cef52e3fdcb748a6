"""Reconciling positions with the universe (JOI-20)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Matching levels in order; a level needs all its fields non-blank.
LEVELS = (
    ("security_id", ("security_id",)), ("cik", ("cik",)), ("cusip", ("cusip",)), ("isin", ("isin",)),
    ("ticker_exchange", ("ticker", "exchange_mic")), ("ticker", ("ticker",)),
)


def reconcile_cascade(
    positions: DataFrame, dim: DataFrame, target: str, levels: Sequence[tuple[str, Sequence[str]]] = LEVELS,
) -> DataFrame:
    """JOI-20. Adds ``matched_id``, ``match_level`` and ``match_status``.

    The first level with any match decides: one match is MATCHED, more is AMBIGUOUS, and
    no level at all is UNMATCHED. All levels are looked up in one pass: the distinct key
    profiles of the positions and the dimension are exploded into (level, key), the
    dimension with a count and least id per key, and each profile keeps its least level.
    Repeated profiles are looked up once, ambiguous keys never multiply the positions, and
    positions without any key meet no key at all.
    """
    clean = lambda c: F.nullif(F.upper(F.trim(F.col(c).cast("string"))), F.lit(""))
    fields = list(dict.fromkeys(f for _, fs in levels for f in fs))

    def keys(prefix: str) -> Column:
        """(level, key) of every level all of whose fields are present; a key is its fields in JSON."""
        made = []
        for n, (_, fs) in enumerate(levels):
            present = F.lit(True)
            for f in fs:
                present = present & F.col(f"{prefix}{f}").isNotNull()
            made.append(F.when(present, F.struct(F.lit(n).alias("level"), F.to_json(F.array(*[F.col(f"{prefix}{f}") for f in fs])).alias("key"))))
        return F.array_compact(F.array(*made))

    named = positions.withColumns({f"_p_{f}": clean(f) for f in fields})
    profile = [f"_p_{f}" for f in fields]
    owners = dim.select(F.col(target).alias("_id"), *[clean(f).alias(f"_d_{f}") for f in fields]).select(
        "_id", F.inline(keys("_d_"))).groupBy("level", "key").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_id"))
    wanted = named.select(*profile).distinct().select(*profile, F.inline(keys("_p_")))
    decided = wanted.join(owners, ["level", "key"]).groupBy(*profile).agg(
        F.min(F.struct("level", "_n", "_id")).alias("_best")
    ).select(*[F.col(c).alias(f"_q{c}") for c in profile], "_best.*")
    same = F.lit(True)
    for c in profile:
        same = same & F.col(c).eqNullSafe(F.col(f"_q{c}"))
    out = named.join(decided, same, "left")
    names = F.array(*[F.lit(n) for n, _ in levels])
    return out.withColumns({
        "match_level": F.get(names, F.col("level")), "matched_id": F.when(F.col("_n") == 1, F.col("_id")),
        "match_status": F.when(F.col("_n") == 1, F.lit("MATCHED")).when(F.col("_n") > 1, F.lit("AMBIGUOUS")).otherwise(F.lit("UNMATCHED")),
    }).select(*positions.columns, "matched_id", "match_level", "match_status")
