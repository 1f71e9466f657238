"""Joint streaks on a stream.

Two steps, so that a key that fills the stream is not handled by one task:

1. The rows of a micro-batch are grouped by (bucket of keys, block of ``span`` order values), in
   parallel also within a key, and all keys of a group are taken at once. In a block all rows of a key are decided except
   the leading ones where no condition has failed yet, and of those only the first ``over``. The
   block passes on its decided rows, these few open rows and one summary row for each key.
2. Per key, in buckets, the summaries are taken in order and meet the counters in state. Where a
   block has many decided rows, they travel in a lane of their own, so that they do not
   gather at their key.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framewise.operators.scan import without_nulls
from framewise.operators.streak import streak_lengths
from framewise.streaming.buckets import BUCKET, InBuckets, bucket_of, states_by_bucket

# Smaller than for tables: a micro-batch holds few frames, and a large key should still
# be spread over several tasks.
STREAM_SPAN = 1 << 16

# Lane of summaries and open rows; of decided rows as well, as long as a block has few. The lane
# only says which task hands a row on, never whether.
_SUMMARY = -1
_FEW = 1000
# Place of decided rows, in front of the block's summary (0) and open rows (1, 2, ...).
_DECIDED = -1


class JointStreak(StatefulProcessor):
    """State is one counter per condition."""

    def __init__(self, keys, order, names, over, ttl_ms):
        self.keys, self.order, self.names = list(keys), list(order), list(names)
        self.over, self.ttl_ms = over, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = ", ".join(f"c{i} long" for i in range(len(self.names)))
        self.counters = handle.getValueState("counters", schema, self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """A key's counters at the end of the history that came before the stream."""
        self.counters.update(tuple(initialState[f"c{i}"] for i in range(len(self.names))))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        event = Row(*self.keys, *self.order)
        if key[-1] != _SUMMARY:
            for row in rows:
                yield event(*key[:-1], *[row[c] for c in self.order])
            return
        columns = ["_block", "_seq", "_n"]
        columns += [f"_{part}_{c}" for c in self.names for part in ("head", "tail")]
        columns += self.order
        # A key's rows may come in several chunks: gather all of them before sorting.
        pieces = sorted(tuple(row[c] for c in columns) for row in rows)
        width = 2 * len(self.names)
        stored = self.counters.get()
        counters = start = [0] * len(self.names) if stored is None else list(stored)
        for _, seq, n, *rest in pieces:
            if seq == _DECIDED:
                yield event(*key[:-1], *rest[width:])
            elif seq == 0:
                start = counters
                ends = zip(start, rest[0:width:2], rest[1:width:2], strict=True)
                counters = [s + n if head == n else tail for s, head, tail in ends]
            elif all(s + seq > self.over for s in start):
                yield event(*key[:-1], *rest[width:])
        self.counters.update(tuple(counters))

    def close(self) -> None:
        pass


def _block_summary(keys: Sequence[str], order: Sequence[str], names: Sequence[str], over: int):
    """The rows of one block, of any number of keys, to what it passes on of each key."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        number = pdf.groupby(list(keys), dropna=False, sort=False).ngroup().to_numpy()
        in_order = np.lexsort([*[pdf[c].to_numpy() for c in reversed(order)], number])
        starts = np.flatnonzero(np.diff(number[in_order], prepend=-1))
        sizes = np.diff(starts, append=len(in_order))
        of = np.repeat(np.arange(len(starts)), sizes)
        at = np.arange(1, len(in_order) + 1)
        place = at - starts[of]
        lengths, heads, tails = [], [], []
        for name in names:
            held = pdf[f"_ok_{name}"].to_numpy(dtype=bool)[in_order]
            # Where a key begins counts like a failure of the row ahead of it.
            lengths.append(at - np.maximum.accumulate(np.where(held, starts[of], at)))
            heads.append(np.minimum.reduceat(np.where(held, sizes[of], place - 1), starts))
            tails.append(lengths[-1][starts + sizes - 1])
        long = np.logical_and.reduce([length > over for length in lengths])
        n_open = np.minimum.reduce([*heads, np.minimum(sizes, over)])
        block = int(pdf["_block"].iloc[0])
        lanes = np.where(np.add.reduceat(long.astype(np.int64), starts) > _FEW, abs(block), _SUMMARY)
        # The summary rows themselves, then the open rows, then the decided ones.
        opened, decided = np.flatnonzero(place <= n_open[of]), np.flatnonzero(long)
        chosen = np.concatenate([starts, opened, decided])
        of_key = of[chosen]
        out = {c: pdf[c].to_numpy()[in_order[chosen]] for c in [*keys, *order]}
        out["_lane"] = np.concatenate([np.repeat(_SUMMARY, len(starts) + len(opened)), lanes[of[decided]]])
        out["_block"] = np.repeat(block, len(chosen))
        out["_seq"] = np.concatenate([np.repeat(0, len(starts)), place[opened], np.repeat(_DECIDED, len(decided))])
        out["_n"] = sizes[of_key]
        for name, head, tail in zip(names, heads, tails, strict=True):
            out[f"_head_{name}"] = head[of_key]
            out[f"_tail_{name}"] = tail[of_key]
        return pd.DataFrame(out)

    return run


def stream_joint_streak(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    conditions: Mapping[str, Column],
    over: int,
    span: int = STREAM_SPAN,
    ttl_ms: int | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """See ``joint_streak``. The rows of a micro-batch count in ``order``, micro-batches as they arrive.

    ``history`` is a table of the rows that came before the stream; counters go on from its end. It is read when the
    query starts for the first time, and becomes a few numbers per key.
    """
    names = list(conditions)
    before = None
    if history is not None:
        kinds, place = {f.name: f.dataType for f in df.schema}, F.struct(*order)
        lengths = streak_lengths(history, keys, order, conditions)
        last = [F.max_by(name, place).alias(f"c{i}") for i, name in enumerate(names)]
        ends = lengths.groupBy(*[F.col(k).cast(kinds[k]).alias(k) for k in keys]).agg(*last)
        before = states_by_bucket(ends, keys).withColumn("_lane", F.lit(_SUMMARY).cast("long")).groupBy(BUCKET, "_lane")
    flags = [F.coalesce(c, F.lit(False)).alias(f"_ok_{name}") for name, c in conditions.items()]
    rows, order, restored = without_nulls(df.select(*keys, *order, *flags), order, span)
    result = T.StructType([rows.schema[c] for c in [*keys, *order]])
    pieces = T.StructType(list(result.fields))
    for name in ["_lane", "_block", "_seq", "_n", *[f"_{part}_{c}" for c in names for part in ("head", "tail")]]:
        pieces = pieces.add(name, T.LongType())
    # Keys with nulls stay by themselves: among others, pandas would turn theirs into floats.
    nulls = F.concat(*[F.col(k).isNull().cast("string") for k in keys]).alias("_nulls")
    blocks = rows.groupBy(bucket_of(keys), "_block", nulls).applyInPandas(_block_summary(keys, order, names, over), pieces)
    one = InBuckets(JointStreak(keys, order, names, over, ttl_ms), keys, ttl_ms)
    found = blocks.withColumn(BUCKET, bucket_of(keys)).groupBy(BUCKET, "_lane").transformWithState(
        one, result, "append", "processingTime" if ttl_ms else "none", before
    )
    return found.select(*keys, *restored)
