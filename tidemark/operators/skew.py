"""Ordered per-key computations as a distributed prefix scan.

A window over a key runs in one task, however many rows the key has. :class:`OrderedKeys`
cuts every key into order-contiguous chunks of about ``CHUNK_ROWS`` rows: running values are
computed inside each chunk, one summary row per (key, chunk) is carried forward, and the two
are combined. The bounds come from a sample that a hash of key and order chooses, so they are
the same in every run, on every cluster and at every size; a key shorter than a chunk simply
has none. Nothing is capped: a longer key has more chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

CHUNK_ROWS = 1 << 20  # rows of one key that a single task orders, about
SAMPLES = 16  # sampled rows a chunk


def as_columns(order: Sequence[Column | str] | Column | str) -> list[Column]:
    if isinstance(order, (str, Column)):
        order = [order]
    return [F.col(o) if isinstance(o, str) else o for o in order]


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Equality of each key with its prefixed copy; NULL keys are a group like any other."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


class OrderedKeys:
    """Rows of ``df`` grouped by ``keys`` and ordered ascending by the columns ``order``.

    ``order`` must be a total order within the key. ``bounded`` says that the caller has
    already limited the rows of a key (a top-n), so that no key needs cutting. An input that
    is the result of joins or windows should be staged by the caller: bounds, chunks and
    summaries each read it.
    """

    def __init__(
        self, df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int | None = None, bounded: bool = False,
    ) -> None:
        self.keys = list(keys)
        self.order = list(order)
        self.df = df
        self.split = not bounded and self._cut(chunk_rows or CHUNK_ROWS)

    def _cut(self, chunk_rows: int) -> bool:
        """Add ``_chunk`` and ``_long`` (whether the key has bounds); False when no key has any.

        The bounds are one row per long key with one value per ``chunk_rows`` rows. They are
        written, so that the planner knows their size when it chooses the join.
        """
        me = F.struct(*self.order)
        every = max(1, chunk_rows // SAMPLES)
        drawn = self.df.filter(F.pmod(F.xxhash64(*self.keys, *self.order), F.lit(every)) == 0).select(*self.keys, me.alias("_o"))
        place = F.row_number().over(Window.partitionBy(*self.keys).orderBy("_o"))
        bounds = drawn.withColumn("_i", place).filter(F.col("_i") % SAMPLES == 0).groupBy(
            *[F.col(k).alias(f"_b_{k}") for k in self.keys]).agg(F.sort_array(F.collect_list("_o")).alias("_bounds"))
        powers = F.transform(F.sequence(F.floor(F.log2(F.size("_bounds"))).cast("int"), F.lit(0)), lambda x: F.pow(F.lit(2), x).cast("int"))
        bounds = stage(bounds.withColumn("_powers", powers), "bounds")
        if not bounds.head(1):
            return False
        # how many bounds lie before the row, by binary search
        before = F.aggregate("_powers", F.lit(0), lambda at, p: F.when(F.get("_bounds", at + p - 1) < me, at + p).otherwise(at))
        self.df = self.df.join(bounds, same_keys(self.keys, "_b_"), "left").withColumns({
            "_chunk": F.coalesce(before, F.lit(0)), "_long": F.col("_bounds").isNotNull(),
        }).drop("_bounds", "_powers", *[f"_b_{k}" for k in self.keys])
        return True

    def running(
        self,
        sums: Mapping[str, Column] | None = None,
        maxima: Mapping[str, Column] | None = None,
        maxima_before: Mapping[str, Column] | None = None,
        products: Mapping[str, Column] | None = None,
    ) -> "OrderedKeys":
        """Add running columns.

        ``sums``, ``maxima`` and ``products`` include the current row; ``maxima_before``
        covers only the rows before it, which with a struct led by the order column is
        the previous row.
        """
        specs = [
            *[(n, c, "sum", 0) for n, c in (sums or {}).items()],
            *[(n, c, "max", 0) for n, c in (maxima or {}).items()],
            *[(n, c, "max", -1) for n, c in (maxima_before or {}).items()],
            *[(n, c, "product", 0) for n, c in (products or {}).items()],
        ]
        make = {"sum": F.sum, "max": F.max, "product": F.product}
        inside = [*self.keys, "_chunk"] if self.split else self.keys
        w = Window.partitionBy(*inside).orderBy(*self.order)
        frames = {0: w.rowsBetween(Window.unboundedPreceding, 0), -1: w.rowsBetween(Window.unboundedPreceding, -1)}
        if not self.split:
            self.df = self.df.withColumns({n: make[kind](c).over(frames[end]) for n, c, kind, end in specs})
            return self

        totals = self.df.filter("_long").groupBy(*[F.col(k).alias(f"_c_{k}") for k in inside]).agg(
            *[make[kind](c).alias(f"_t_{n}") for n, c, kind, _ in specs])
        copies = [f"_c_{k}" for k in inside]
        before = Window.partitionBy(*copies[:-1]).orderBy(copies[-1]).rowsBetween(Window.unboundedPreceding, -1)
        carry = totals.select(*copies, *[make[kind](F.col(f"_t_{n}")).over(before).alias(f"_b_{n}") for n, _, kind, _ in specs])
        local = self.df.withColumns({f"_l_{n}": make[kind](c).over(frames[end]) for n, c, kind, end in specs})
        # one row per chunk; the large side is already partitioned by these keys
        joined = local.join(carry, same_keys(inside, "_c_"), "left")

        def combine(name: str, kind: str) -> Column:
            b, l = F.col(f"_b_{name}"), F.col(f"_l_{name}")
            if kind == "max":
                return F.greatest(b, l)
            both = b + l if kind == "sum" else b * l
            return F.coalesce(both, b, l)

        self.df = joined.withColumns({n: combine(n, kind) for n, _, kind, _ in specs}).drop(
            *copies, *[f"_b_{n}" for n, *_ in specs], *[f"_l_{n}" for n, *_ in specs]
        )
        return self

    def maximum(self, name: str, column: Column) -> "OrderedKeys":
        """Add the largest value of ``column`` among all rows of the key."""
        inside = [*self.keys, "_chunk"] if self.split else self.keys
        local = self.df.withColumn(name, F.max(column).over(Window.partitionBy(*inside)))
        if not self.split:
            self.df = local
            return self
        copies = [f"_c_{k}" for k in inside]
        chunks = self.df.filter("_long").groupBy(*[F.col(k).alias(c) for k, c in zip(inside, copies, strict=True)]).agg(F.max(column).alias("_t"))
        whole = chunks.select(*copies, F.max("_t").over(Window.partitionBy(*copies[:-1])).alias("_w"))
        # one row per chunk, as in running
        joined = local.join(whole, same_keys(inside, "_c_"), "left")
        self.df = joined.withColumn(name, F.greatest(name, "_w")).drop(*copies, "_w")
        return self

    def with_columns(self, columns: Mapping[str, Column]) -> "OrderedKeys":
        self.df = self.df.withColumns(dict(columns))
        return self

    def result(self) -> DataFrame:
        return self.df.drop("_long", "_chunk") if self.split else self.df


def previous_row(order: str, *columns: str) -> Column:
    """Struct whose running maximum over earlier rows is the previous row."""
    return F.struct(F.col(order), *[F.col(c) for c in columns])
