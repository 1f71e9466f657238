"""Packing of documents into sequences of a fixed number of tokens, by best-fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.bestfit import Rule, plan
from framewise.llm.columns import whole_text
from framewise.llm.encoding import encoder
from framewise.settings import write_through

CAPACITY = 2048

# Ids that a task gathers before it hands pieces on.
_FLUSH = 1 << 20

_RULES = ("_length", "first", "pieces", "each", "window", "at")


def pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Each document's ids, closed by ``end_id`` and cut into full windows and one remainder.

    Columns: ``key``, start, length, ids_crc32, doc_tokens, and the piece's ids if ``with_ids``.
    A null text counts as empty and is one piece of one id. Nothing depends on other rows.
    """
    source = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    fields = [
        source.schema["key"],
        *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")],
        *[T.StructField("ids", T.ArrayType(T.LongType()))] * with_ids,
    ]
    kinds = {"ids": pa.list_(pa.int64())}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        for batch in batches:
            owner, rows, size = [], [[] for _ in fields[1:]], 0

            def made() -> pa.RecordBatch:
                columns = [batch.column("key").take(pa.array(owner, pa.int64()))]  # noqa: B023
                columns += [pa.array(x, kinds.get(f.name, pa.int64())) for f, x in zip(fields[1:], rows)]  # noqa: B023
                return pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

            for i, content in enumerate(batch.column("text")):
                ids = np.append(encode(content.as_py()), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    owner.append(i)
                    values = [start, len(part), zlib.crc32(part.tobytes()), len(ids), *[part.astype(np.int64)] * with_ids]
                    for column, value in zip(rows, values):
                        column.append(value)
                size += len(ids)
                if size > _FLUSH:
                    yield made()
                    owner, rows, size = [], [[] for _ in fields[1:]], 0
            yield made()

    return source.mapInArrow(cut, T.StructType(fields)).withColumnRenamed("key", key)


def assign(cut: DataFrame, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """``cut`` (from :func:`pieces`) with ``sequence_id`` and ``offset``.

    Pieces of one length are interchangeable, so a piece's place follows from its number among
    them. They are numbered in slices of each length (hash of key and start), as many as there
    are shuffle partitions, so that a length that most documents share is spread out. Only the
    number of pieces of each length, ``capacity`` numbers at most, comes to the driver, and only
    the rules go back, a few for each length.
    """
    spark = cut.sparkSession
    slices = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = write_through(cut.withColumn("_slice", F.pmod(F.xxhash64(key, "start"), F.lit(slices))), "pieces")
    sizes = rows.groupBy("length", "_slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))

    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rules, _ = plan(counts, capacity)
    # Without pieces, a rule that places none.
    rules = rules or [Rule(0, 0, 0, 1, 0, 0)]
    local = zip(*[(r.length, r.first, r.pieces, r.each, r.window, r.offset) for r in rules])
    # Through Arrow: for a list of rows, Spark starts further Python workers on the executors.
    table = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in local], names=_RULES))

    within = Window.partitionBy("length", "_slice").orderBy(key, "start", "ids_crc32")
    numbered = rows.withColumn("_n", F.row_number().over(within)).join(bases, ["length", "_slice"])
    numbered = numbered.withColumn("_n", F.col("_base") + F.col("_n") - 1)
    # The rules' number is bounded by the capacity.
    of_rule = (F.col("_n") >= F.col("first")) & (F.col("_n") < F.col("first") + F.col("pieces"))
    placed = numbered.join(F.broadcast(table), (F.col("length") == F.col("_length")) & of_rule)
    return placed.select(
        *[F.col(f"`{c}`") for c in cut.columns],
        F.expr("window + (_n - first) div each").alias("sequence_id"),
        F.expr("at + (_n - first) % each * length").alias("offset"),
    )


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: where it comes from, and its sequence and offset there.

    Overlong documents are cut into full windows first; all pieces are then placed in order of
    falling length, each into the open sequence with the least room that holds it. Offsets have
    no gaps from 0 on.

    Null or empty texts are one piece of one id; rows without a key are packed too. Repeated rows
    and equal keys are packed once per row; which of two equal pieces comes first is open. An
    empty table gives no rows. Further columns are not carried along: join on ``key``.
    """
    return assign(pieces(docs, vocabulary, end_id, capacity, key, text, with_ids), capacity, key)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, padded_to, ids.

    ``packed`` must have been made ``with_ids``. A sequence is padded to ``capacity``, unless its
    number of tokens is a power of two. A group holds ``capacity`` ids at most.
    """
    gathered = packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids")
    )
    count = F.size("ids")
    target = F.when(count.bitwiseAND(count - 1) == 0, count).otherwise(F.lit(capacity))
    return gathered.select(
        "sequence_id",
        count.cast("long").alias("n_tokens"),
        target.cast("long").alias("padded_to"),
        F.concat("ids", F.array_repeat(F.lit(pad_id).cast("long"), target - count)).alias("ids"),
    )
