"""Keyed state for many keys with few rows each.

Spark hands each key of a micro-batch to Python by itself, with several calls for its state. Where keys are many that
takes far longer than the work. Here keys are dealt to a fixed number of buckets by their hash; a bucket is one group, whose
state is read and written once in a micro-batch, and its keys are handled one after the other by the processor of one key.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: States are kept by bucket, so a checkpoint is only good for this number.
BUCKETS = 1024

BUCKET = "_bucket"


def bucket_of(keys: Sequence[str]) -> Column:
    """The bucket of a key, also of one with nulls. The types of ``keys`` must be the same wherever states are to meet."""
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias(BUCKET)


def states_by_bucket(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A table of one state per key as one row per bucket, for the initial state of ``InBuckets``."""
    entry = F.struct(F.struct(*keys).alias("key"), F.struct(*[c for c in states.columns if c not in keys]).alias("state"))
    return states.groupBy(bucket_of(keys)).agg(F.collect_list(entry).alias("states"))


def _alike(value):
    """Values that Spark groups together as values that are equal and can be looked up."""
    if isinstance(value, float) and value != value:
        return "NaN", None
    if isinstance(value, list | tuple):
        return tuple(_alike(v) for v in value)
    return bytes(value) if isinstance(value, bytearray) else value


class _Held:
    """A key's value state within the bucket's: each entry is the value and when it was last changed."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms, self.now, self.changed = ttl_ms, 0, False
        self.entries: dict[tuple, tuple] = {}
        self.key: tuple = ()

    def get(self) -> tuple | None:
        found = self.entries.get(self.key)
        return None if found is None or self._past(found) else found[0]

    def update(self, value: tuple) -> None:
        self.entries[self.key] = (tuple(value), self.now)
        self.changed = True

    def _past(self, entry: tuple) -> bool:
        return self.ttl_ms is not None and entry[1] + self.ttl_ms <= self.now

    def loaded(self, stored: tuple | None, now: int) -> None:
        self.entries, self.now, self.changed = {} if stored is None else pickle.loads(stored[0]), now, False

    def dumped(self) -> tuple:
        kept = {key: entry for key, entry in self.entries.items() if not self._past(entry)}
        return (pickle.dumps(kept, pickle.HIGHEST_PROTOCOL),)


class _OneValue:
    """What the processor of one key sees as its handle. It has one value state."""

    def __init__(self, held: _Held):
        self.held = held

    def getValueState(self, name: str, schema, ttl_ms: int | None = None) -> _Held:
        return self.held


class InBuckets(StatefulProcessor):
    """Runs ``one``, the processor of one key with one value state, over the keys of a bucket.

    Groups are a bucket and any further columns, which ``one`` gets behind the key. ``ttl_ms`` counts for each key.
    """

    def __init__(self, one: StatefulProcessor, keys: Sequence[str], ttl_ms: int | None):
        self.one, self.keys, self.ttl_ms = one, list(keys), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # A bucket is changed whenever one of its keys is, so it lives as long as the latest of them.
        self.states = handle.getValueState("states", "keys binary", self.ttl_ms)
        self.held = _Held(self.ttl_ms)
        self.one.init(_OneValue(self.held))

    def _load(self, timerValues) -> None:
        stored = self.states.get()
        self.held.loaded(stored, timerValues.getCurrentProcessingTimeInMs() if self.ttl_ms else 0)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._load(timerValues)
        for entry in initialState["states"]:
            values = tuple(entry["key"][k] for k in self.keys)
            self.held.key = _alike(values)
            self.one.handleInitialState(values, entry["state"], timerValues)
        self.states.update(self.held.dumped())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        groups: dict[tuple, tuple[tuple, list]] = {}
        for row in rows:
            values = tuple(row[c] for c in self.keys)
            groups.setdefault(_alike(values), (values, []))[1].append(row)
        if not groups:
            return
        self._load(timerValues)
        for same, (values, mine) in groups.items():
            self.held.key = same
            yield from self.one.handleInputRows((*values, *key[1:]), iter(mine), timerValues)
        if self.held.changed:
            self.states.update(self.held.dumped())

    def close(self) -> None:
        self.one.close()
