"""Running values per key that stay parallel when one key holds much of the data.

A plain ``Window.partitionBy(key)`` sends all rows of a key to one task. Here a key's
rows are cut into blocks of ``span`` consecutive order values, and work on rows is
partitioned by (key, block):

1. a window over (key, block) gives the running values inside each block, of which the last one is the block's total;
2. a window over these totals, one small row per block, gives what every block starts from;
3. the start values join the rows, using the partitioning and the order that the first window left.

Rows are shuffled once: where all of their columns take part, Spark finds that rows and totals need the same
shuffle and does it once (the plan shows ``ReusedExchange``); further columns make it read them twice.

A block holds at most ``span`` order values of a key, and the window of step 2 has one
row per block that the key has rows in. A million frames is a good measure: few enough
rows for one task, and so many that keys with few rows are hardly cut at all. The result
never depends on ``span``; ``None`` skips the cutting, for data known to have no large key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPAN = 1 << 20

_BLOCK = "_block"


@dataclass(frozen=True)
class Running:
    """``how`` over the key's rows up to this one, or before it if not ``inclusive``.

    ``sum`` and ``max`` ignore nulls; ``last`` is the latest value that is not null.
    """

    name: str
    value: Column
    how: str
    inclusive: bool = True

    def total(self, running: str, order: Sequence[str]) -> Column:
        """Of a block, from its running values up to each row."""
        return F.max(running) if self.how == "max" else F.max_by(running, F.struct(*order))

    def joined(self, start: str, inside: str) -> Column:
        """The running value from what the block starts with and the running value inside."""
        if self.how == "sum":
            return F.coalesce(F.col(start) + F.col(inside), start, inside)
        return F.greatest(start, inside) if self.how == "max" else F.coalesce(inside, start)

    def over(self, value: str, window) -> Column:
        if self.how == "last":
            return F.last(value, ignorenulls=True).over(window)
        return {"sum": F.sum, "max": F.max}[self.how](value).over(window)


def _never_null(df: DataFrame, key: str) -> list[Column]:
    """Columns that tell the values of ``key`` apart, also null, without being null."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.NumericType | T.StringType):
        zero = F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)
        return [F.coalesce(key, zero).alias(f"_key_{key}"), F.col(key).isNull().alias(f"_null_{key}")]
    return [F.struct(key).alias(f"_key_{key}")]


def key_columns(df: DataFrame, keys) -> tuple[list[Column], list[str]]:
    solid = [c for k in keys for c in _never_null(df, k)]
    return solid, df.select(*solid).columns


def restored_key(columns: Sequence[str], key: str) -> Column:
    value = F.col(f"_key_{key}")
    if f"_null_{key}" in columns:
        return F.when(~F.col(f"_null_{key}"), value).alias(key)
    return value[key].alias(key)


def block_of(column: str, span: int) -> Column:
    return F.expr(f"{column} div {int(span)}")


# A block for rows without a place, ahead of all others.
_NO_PLACE = -(1 << 60)


def without_nulls(df: DataFrame, order: Sequence[str], span: int) -> tuple[DataFrame, list[str], list[Column]]:
    """``df`` with integer columns to order by that are never null, and its ``_block``.

    Code outside of Spark has no one way to sort nulls. Gives the rows, the names of the new
    columns, in which nulls come first as in Spark, and the columns that restore ``order``.
    """
    solid, restored = [], []
    for c in order:
        there, value = f"_there_{c}", f"_value_{c}"
        solid += [F.col(c).isNotNull().cast("int").alias(there), F.coalesce(c, F.lit(0).cast(df.schema[c].dataType)).alias(value)]
        restored.append(F.when(F.col(there) == 1, F.col(value)).alias(c))
    block = F.coalesce(block_of(order[0], span), F.lit(_NO_PLACE)).alias("_block")
    names = [f"_{part}_{c}" for c in order for part in ("there", "value")]
    return df.select("*", *solid, block).drop(*order), names, restored


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    running: Sequence[Running],
    span: int | None = SPAN,
) -> DataFrame:
    """``df`` with one column per entry of ``running``. Null keys form groups of their own.

    The first column of ``order`` must be an integer; it is the one cut into blocks.
    """
    values = {r.name: f"_v{i}" for i, r in enumerate(running)}
    valued = [r.value.alias(values[r.name]) for r in running]
    if span is None:
        rows = df.select("*", *valued)
        return _run(rows, keys, order, running, values).drop(*values.values())

    # Rows and totals both read what the window gives, so that they need the same columns of the same shuffle.
    solid, names = key_columns(df, keys)
    inside = [Running(f"_in{i}", r.value, r.how) for i, r in enumerate(running)]
    others = [c for c in df.columns if c not in keys]
    rows = df.select(*others, *solid, *valued, block_of(order[0], span).alias(_BLOCK))
    held = {w.name: values[r.name] for w, r in zip(inside, running)}
    earlier = [Running(f"_ex{i}", r.value, r.how, False) for i, r in enumerate(running) if not r.inclusive]
    held |= {w.name: f"_v{w.name[3:]}" for w in earlier}
    placed = _run(rows, [*names, _BLOCK], order, [*inside, *earlier], held)

    totals = placed.groupBy(*names, _BLOCK).agg(*[r.total(w.name, order).alias(values[r.name]) for w, r in zip(inside, running)])
    before = Window.partitionBy(*names).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = {r.name: f"_start{i}" for i, r in enumerate(running)}
    heads = totals.select(*names, _BLOCK, *[r.over(values[r.name], before).alias(starts[r.name]) for r in running])
    heads = heads.dropna(how="all", subset=list(starts.values()))

    joined = placed.join(heads, [*names, _BLOCK], "left")
    found = {r.name: r.joined(starts[r.name], f"_in{i}" if r.inclusive else f"_ex{i}") for i, r in enumerate(running)}
    kept = [restored_key(names, c) if c in keys else F.col(c) for c in df.columns]
    return joined.select(*kept, *[c.alias(name) for name, c in found.items()])


def _run(rows, keys, order, running, values) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    ends = {True: Window.currentRow, False: -1}
    return rows.select(
        "*",
        *[
            r.over(values[r.name], window.rowsBetween(Window.unboundedPreceding, ends[r.inclusive])).alias(r.name)
            for r in running
        ],
    )
