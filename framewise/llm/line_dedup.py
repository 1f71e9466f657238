"""Removal of lines that many documents share, found by two Bloom filters and confirmed exactly."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.columns import pack_row, whole_text, without
from framewise.llm.words import LOWER_ASCII
from framewise.settings import write_through

_BLANKS = b" \t\n\v\f\r"
#: A filter is kept in so many bytes at a time: the unit in which tasks' filters are merged.
_SEGMENT = 1 << 16

#: Filter bytes: 2 for each line, but at least one segment and at most ``MOST``. Beyond, more lines
#: are suspected without cause; the exact step sorts them out.
BYTES_PER_LINE = 2
MOST = 1 << 26


def line_key(line: bytes) -> bytes:
    """What is compared of a line: blanks at both ends stripped, A-Z in lower case."""
    return line.strip(_BLANKS).translate(LOWER_ASCII)


def _keys(text: str, least: int) -> list[bytes | None]:
    """For each line its key, None if that is shorter than ``least`` code points."""
    found = []
    for line in text.encode().split(b"\n"):
        key = line_key(line)
        long_enough = len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)
        found.append(key if long_enough else None)
    return found


def _lines(text: Column) -> Column:
    """The number of lines of a text that is not null."""
    return F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1


def _places(keys: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit masks of each key in a filter of ``size`` bytes: two bits, in one 64-byte block."""
    h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
    block = (h % np.uint64(size // 64)).astype(np.int64) * 512
    bits = np.stack([(h >> np.uint64(46)) & np.uint64(511), (h >> np.uint64(55)) & np.uint64(511)]).astype(np.int64) + block
    return bits >> 3, (1 << (bits & 7)).astype(np.uint8)


def _seen(filter_: np.ndarray, where: np.ndarray, masks: np.ndarray) -> np.ndarray:
    return np.all(filter_[where] & masks != 0, axis=0)


def repeated_filter(docs: DataFrame, text: str = "text", least: int = 20) -> bytes:
    """A Bloom filter of the keys that at least two rows hold.

    Each task fills two filters: keys seen once, and keys seen again. Merging is a union of
    the first, and of the second a union that also takes in what two tasks' first filters share.
    It is done segment by segment in a shuffle, of which rows are compressed segments with at
    least one bit. What comes to the driver and is sent to the workers is the one merged filter,
    at most ``MOST`` bytes.
    """
    lines = docs.agg(F.sum(_lines(whole_text(text)))).first()[0] or 0
    size = _SEGMENT
    while size < min(BYTES_PER_LINE * lines, MOST):
        size *= 2

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for batch in batches:
            for content in batch.column(0):
                keys = list({k for k in _keys(content.as_py(), least) if k is not None})
                if keys:
                    where, masks = _places(keys, size)
                    again = _seen(once, where, masks)
                    # Two keys of one document may share bits: that only adds a suspect.
                    np.bitwise_or.at(twice, where[:, again], masks[:, again])
                    np.bitwise_or.at(once, where, masks)
        parts = [i for i in range(size // _SEGMENT) if once[i * _SEGMENT : (i + 1) * _SEGMENT].any()]
        for at in range(0, len(parts), 16):
            some = parts[at : at + 16]
            packed = [[zlib.compress(f[i * _SEGMENT : (i + 1) * _SEGMENT].tobytes(), 1) for i in some] for f in (once, twice)]
            columns = [pa.array(some, pa.int32()), *[pa.array(p, pa.binary()) for p in packed]]
            yield pa.RecordBatch.from_arrays(columns, ["part", "once", "twice"])

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(_SEGMENT, np.uint8), np.zeros(_SEGMENT, np.uint8)
        for batch in batches:
            for a, b in zip(batch.column("once"), batch.column("twice")):
                other = np.frombuffer(zlib.decompress(a.as_py()), np.uint8)
                twice |= np.frombuffer(zlib.decompress(b.as_py()), np.uint8) | (once & other)
                once |= other
        if twice.any():
            columns = [pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(twice.tobytes(), 1)])]
            yield pa.RecordBatch.from_arrays(columns, ["part", "twice"])

    filled = docs.select(whole_text(text).alias("text")).mapInArrow(fill, "part int, once binary, twice binary")
    merged = filled.groupBy("part").applyInArrow(merge, "part int, twice binary")
    whole = np.zeros(size, np.uint8)
    for row in merged.toLocalIterator():
        whole[row["part"] * _SEGMENT : (row["part"] + 1) * _SEGMENT] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return whole.tobytes()


def drop_shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 20, documents: int = 3) -> DataFrame:
    """``docs`` without the lines that at least ``documents`` documents hold, but for their last holder.

    Lines are split at ``\\n`` and compared by :func:`line_key`; only keys of ``least`` code points
    or more count. All lines with a shared key go, except those of the largest ``key`` value
    that holds it. The text is replaced, and ``n_lines`` (before) and ``n_dropped`` are added, in
    place of input columns of these names.

    Documents without a suspected line pass through and are never shuffled. Of the others, the
    suspected keys are grouped by the key itself, with partial counts ahead of the shuffle.

    A null text is one empty line and stays null if nothing is dropped, which is always so. A
    row without a ``key`` value is no document: it loses nothing and doesn't count. Rows with
    the same ``key`` value are one document: a line in several of them counts once, and they lose
    or keep it alike. An empty table gives an empty table; further columns pass through.
    """
    docs = without(docs, "n_lines", "n_dropped")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(repeated_filter(docs, text, least))
    key_type = docs.schema[key].dataType
    rows = docs.select(pack_row(docs), F.col(key).alias("_key"), whole_text(text).alias("_text"))

    suspect = T.StructType([T.StructField("_key", key_type), T.StructField("_line", T.StringType())])

    def suspects_of(content: str, filter_: np.ndarray) -> list[bytes]:
        keys = list(dict.fromkeys(k for k in _keys(content, least) if k is not None))
        if not keys:
            return []
        return [k for k, hit in zip(keys, _seen(filter_, *_places(keys, len(filter_)))) if hit]

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            owner, found = [], []
            for i, content in enumerate(batch.column("_text")):
                for k in suspects_of(content.as_py(), filter_):
                    owner.append(i)
                    found.append(k.decode())
            columns = [batch.column("_key").take(pa.array(owner, pa.int64())), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["_key", "_line"])

    @F.pandas_udf("boolean")
    def suspected(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        filter_ = np.frombuffer(shared.value, np.uint8)
        for texts in batches:
            yield pd.Series([bool(suspects_of(t, filter_)) for t in texts], dtype=bool)

    found = write_through(
        rows.where(F.col("_key").isNotNull())
        .select("_key", "_text")
        .mapInArrow(suspects, suspect),
        "suspected-lines",
    )
    holders = found.groupBy("_line").agg(F.count_distinct("_key").alias("_n"), F.max("_key").alias("_last"))
    # Written, so that the join below stands on plain shuffles, of which Spark can split a frequent line's part.
    holders = write_through(holders.where(F.col("_n") >= documents), "shared-lines")
    drops = (
        found.join(holders, "_line")
        .where(F.col("_key") != F.col("_last"))
        .groupBy("_key")
        .agg(F.collect_set("_line").alias("_lines"))
    )

    @F.pandas_udf("text string, dropped long")
    def rewrite(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, lines in batches:
            kept, dropped = [], []
            for content, gone in zip(texts, lines):
                if gone is None:
                    kept.append(content)
                    dropped.append(0)
                    continue
                gone = {x.encode() for x in gone}
                before = content.encode().split(b"\n")
                after = [x for x in before if line_key(x) not in gone]
                kept.append(b"\n".join(after).decode())
                dropped.append(len(before) - len(after))
            yield pd.DataFrame({"text": kept, "dropped": dropped})

    marked = rows.withColumn("_suspected", F.col("_key").isNotNull() & suspected("_text"))
    columns = [F.col(f"_row.`{c}`") for c in docs.columns]
    lines = _lines(F.col("_text")).cast("long").alias("n_lines")
    clean = marked.where(~F.col("_suspected")).select(*columns, lines, F.lit(0).cast("long").alias("n_dropped"))
    changed = F.col("_new.dropped") > 0
    rest = (
        marked.where("_suspected")
        .join(drops, "_key", "left")
        .withColumn("_new", rewrite("_text", "_lines"))
        .select(
            *[F.when(changed, F.col("_new.text")).otherwise(c).alias(n) if n == text else c for n, c in zip(docs.columns, columns)],
            lines,
            F.col("_new.dropped").alias("n_dropped"),
        )
    )
    return clean.unionByName(rest)
