"""Document fingerprints: the shingle hashes below a fixed fraction of all hashes.

Since every text keeps the same part of the hashes, fingerprints of texts of very unequal length can
be compared, united and searched for containment. A fingerprint is a string: a hash of the whole
text, a colon, and the kept hashes in base64, four bytes each, ascending.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.columns import whole_text, without
from framewise.llm.words import mix

#: Code points of a shingle. A shorter text is one shingle.
SHINGLE = 8
#: One hash in so many is kept.
SCALE = 16

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PIECE = 1 << 18


def _sketch(text: str) -> np.ndarray:
    """The kept hashes of a text, their upper 32 bits, ascending."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    if not len(points):
        return np.empty(0, np.uint32)
    width = min(SHINGLE, len(points))
    found = []
    for at in range(0, len(points) - width + 1, _PIECE):
        part = mix(points[at : at + _PIECE + width - 1] + np.uint64(1))
        count = len(part) - width + 1
        value = np.full(count, width, np.uint64)
        for i in range(width):
            value *= _BASE
            value += part[i : i + count]
        high = (mix(value) >> np.uint64(32)).astype(np.uint32)
        found.append(high[high < (1 << 32) // SCALE])
    return np.unique(np.concatenate(found))


def fingerprint_of(text: str) -> str:
    whole = hashlib.blake2b(text.encode(), digest_size=8).hexdigest()
    return f"{whole}:{base64.b64encode(_sketch(text).astype('<u4').tobytes()).decode()}"


def _hashes(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.partition(":")[2]), "<u4")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def likeness(one: str, other: str) -> float:
    """Estimated share of common shingles in all of two texts' shingles; 1 for equal texts.

    Two different texts too short to have kept a hash have likeness 0.
    """
    if one.partition(":")[0] == other.partition(":")[0]:
        return 1.0
    a, b = _hashes(one), _hashes(other)
    common = _common(a, b)
    return common / max(len(a) + len(b) - common, 1)


def containment(one: str, other: str) -> float:
    """Estimated share of the first text's shingles that the second one has; 1 for equal texts."""
    if one.partition(":")[0] == other.partition(":")[0]:
        return 1.0
    a = _hashes(one)
    return _common(a, _hashes(other)) / max(len(a), 1)


def merged(one: str, other: str) -> str:
    """The fingerprint of both texts' shingles together. It names no whole text."""
    both = np.union1d(_hashes(one), _hashes(other))
    return f":{base64.b64encode(both.astype('<u4').tobytes()).decode()}"


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``, which depends on the text alone; null counts as empty.

    Equal texts have equal fingerprints. An input column of that name is replaced, others pass
    through, an empty table gives an empty table.
    """

    @F.pandas_udf("string")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(fingerprint_of)

    return without(docs, "fingerprint").withColumn("fingerprint", make(whole_text(text)))


def _ranges(docs: DataFrame, key: str) -> tuple[np.ndarray, dict[int, int]]:
    """Borders of key ranges of about equal numbers of rows, and which range's first key each is.

    As many ranges as there are shuffle partitions: a few numbers for each come to the driver.
    """
    count = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = docs.select(F.col(key).cast("long").alias("k"))
    shares = [i / count for i in range(1, count)]
    borders = keys.agg(F.percentile_approx("k", shares, 100 * count)).first()[0] if shares else []
    borders = np.unique(np.array(borders or [], np.int64))

    @F.pandas_udf("int")
    def range_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, k.to_numpy(), side="right").astype("int32"))

    heads = keys.where(F.col("k").isNotNull()).groupBy(range_of("k").alias("r")).agg(F.min("k").alias("first")).collect()
    return borders, {r["r"]: r["first"] for r in heads}


def compare_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts, of their edited forms and of the next texts, compared.

    Columns: ``key``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    The edited text has the last quarter of the code points (rounded down) replaced by as many
    from the beginning of the next document (all, if it has fewer), in the order of the integer
    ``key``; the first one follows the last.

    Null texts are empty. Equal keys follow each other in the order of their texts, then as they
    come. Rows with a null key are not in the order: their next document is an empty text. A
    single document follows itself. An empty table gives an empty table; further columns are
    not carried along.

    Rows are dealt out by ranges of the key and sorted there, one shuffle of the texts. The first
    row of each range goes to the range before as well, where it only serves as a next one.
    """
    borders, heads = _ranges(docs, key)
    ranges = sorted(heads)
    before = {heads[r]: ranges[i - 1] for i, r in enumerate(ranges)}
    firsts = np.array(sorted(before), np.int64)
    count = len(borders) + 1

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series) -> pd.Series:
        values = keys.to_numpy(np.int64)
        own = np.searchsorted(borders, values, side="right")
        head = np.isin(values, firsts)
        return pd.Series([[int(r), before[int(k)]] if h else [int(r)] for r, h, k in zip(own, head, values)])

    rows = docs.select(F.col(key).alias("key"), F.col(key).cast("long").alias("k"), whole_text(text).alias("text"))
    # pandas has no nulls among integers; rows without a key go to the first range.
    where = F.when(F.col("k").isNull(), F.array(F.lit(0))).otherwise(places(F.coalesce("k", F.lit(0))))
    rows = rows.select("key", "k", "text", F.posexplode(where).alias("extra", "range"))
    dealt = rows.repartitionById(count, F.col("range")).sortWithinPartitions("range", "extra", "k", "text")
    doubles = [T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")]
    strings = [T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    schema = T.StructType([rows.schema["key"], T.StructField("n_chars", T.LongType()), *strings, *doubles])

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, waiting, full, size = None, None, [], 0

        def judged(now: tuple, after: tuple | None) -> tuple:
            key_, _, _, content, own = now
            follower, other = after[3:] if after else ("", fingerprint_of(""))
            quarter = len(content) // 4
            edited = content[: len(content) - quarter] + follower[:quarter]
            changed = fingerprint_of(edited)
            digest = hashlib.sha256(edited.encode()).hexdigest()
            return key_, len(content), digest, own, changed, likeness(own, changed), likeness(own, other)

        def flush() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*full), kinds)], names=[f.name for f in schema])

        for batch in batches:
            kind = batch.column("key").type
            for values in zip(*(batch.column(c) for c in ("key", "k", "extra", "text"))):
                if waiting and waiting[2]:
                    break  # of the rows lent by the next range, only the first counts
                row = tuple(v.as_py() for v in values)
                row += (fingerprint_of(row[3]),)
                if waiting:
                    full.append(judged(waiting, None if waiting[1] is None else row))
                    size += len(waiting[3])
                waiting = row
                if size > 1 << 21:
                    yield flush()
                    full, size = [], 0
        if waiting and not waiting[2]:
            full.append(judged(waiting, None))
        if full:
            yield flush()

    return dealt.mapInArrow(edit, schema).withColumnRenamed("key", key)
