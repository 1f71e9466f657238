"""The n-th occurrence of a key on a stream."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framewise.operators.scan import SPAN, without_nulls
from framewise.streaming.buckets import BUCKET, InBuckets, bucket_of, states_by_bucket

_MORE = "_more"


class NthOccurrence(StatefulProcessor):
    """State is a key's count, which stops growing at ``n``."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], n: int, ttl_ms: int | None):
        self.keys, self.order, self.n, self.ttl_ms = list(keys), list(order), n, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long", self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        """A key's count in the history that came before the stream."""
        self.count.update((initialState["n"],))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        places, more = [], 0
        for row in rows:
            places.append(tuple(row[c] for c in self.order))
            more += row[_MORE]
        stored = self.count.get()
        before = 0 if stored is None else stored[0]
        if before >= self.n:
            return
        after = before + len(places) + more
        self.count.update((min(after, self.n),))
        if after >= self.n:
            # The rows left out of ``places`` all come after this one.
            places.sort()
            yield Row(*self.keys, *self.order)(*key, *places[self.n - before - 1])

    def close(self) -> None:
        pass


def _first_rows(keys: Sequence[str], order: Sequence[str], n: int):
    """Reduces each Arrow batch to the first ``n`` rows per key and the number of others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ordered = pdf.sort_values(list(order))
            groups = ordered.groupby(list(keys), dropna=False, sort=False)
            place = groups.cumcount()
            size = groups[order[0]].transform("size")
            ordered[_MORE] = (size - n).where(place == n - 1, 0).clip(lower=0)
            yield ordered[place < n]

    return run


def stream_nth_occurrence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    ttl_ms: int | None = None,
    history: DataFrame | None = None,
    mode: str = "append",
) -> DataFrame:
    """See ``nth_occurrence``. The rows of a micro-batch count in ``order``, micro-batches as they arrive.

    Before the shuffle each task keeps at most ``n`` rows of a key per Arrow batch and the
    number of the others, so a key that fills the stream stays cheap. Keys are handled in buckets (see ``InBuckets``).

    ``ttl_ms`` forgets a key that long after its last change. Time to live needs a clock, so
    such a query goes on with empty micro-batches: give it a trigger interval.

    ``history`` is a table of the rows that came before the stream; counts go on from there. It is read when the
    query starts for the first time, and becomes one number per key. ``mode`` is the output mode of the query.
    """
    rows, order, restored = without_nulls(df.select(*keys, *order), order, SPAN)
    rows = rows.drop("_block")
    reduced = T.StructType([*rows.schema.fields, T.StructField(_MORE, T.LongType())])
    first = rows.mapInPandas(_first_rows(keys, order, n), reduced)
    before = None
    if history is not None:
        kinds = {f.name: f.dataType for f in df.schema}
        counted = history.select(*[F.col(k).cast(kinds[k]) for k in keys]).groupBy(*keys).agg(F.least(F.count("*"), F.lit(n)).alias("n"))
        before = states_by_bucket(counted, keys).groupBy(BUCKET)
    one = InBuckets(NthOccurrence(keys, order, n, ttl_ms), keys, ttl_ms)
    found = first.withColumn(BUCKET, bucket_of(keys)).groupBy(BUCKET).transformWithState(
        one, rows.schema, mode, "processingTime" if ttl_ms else "none", before
    )
    return found.select(*keys, *restored)
