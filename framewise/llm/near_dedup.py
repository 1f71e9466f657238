"""Near duplicates by min-max hashing: candidates from banded signatures, links confirmed on full sets.

Under each permutation of the hashes both the smallest and the largest value of a set are kept:
twice the values for one evaluation. Two sets agree in either with the probability of their
similarity. Values are banded four by four. With 64 permutations there are 32 bands, and a pair at
similarity 0.8 shares none of them with a probability of 5e-8.

What happens to large groups:

* Documents with one and the same set are one class, found by a digest of the set. Only the class
  takes part in the rest.
* In a bucket (equal band) every class is compared with one class, the bucket's centre. For most
  groups of copies this already links them all.
* What is still in different components within a bucket meets in blocks, but only classes outside
  the bucket's main component with the bucket. Of those that meet, pairs are compared that share one of
  their rarest shingles and are of like size: a pair at the wanted similarity must, so every pair in a
  bucket is compared, known to be in one component, or known to be apart. Neither a group of n near
  copies nor n pages that share a template take n * n comparisons.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm.columns import whole_text
from framewise.llm.components import components
from framewise.llm.words import LOWER_ASCII, mix, shingles, word_hashes
from framewise.settings import write_through

PERMUTATIONS = 64
ROWS = 4

#: What meets in a block: bytes of the sets on each side, and pairs, on average at most.
BLOCK_BYTES = 4 << 20
BLOCK_PAIRS = 1_000_000

_MULTIPLY = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = mix(np.arange(1001, PERMUTATIONS + 1001, dtype=np.uint64))
_STEP = 2048


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the distinct word shingles; A-Z count as a-z."""
    return shingles(word_hashes(text.encode().translate(LOWER_ASCII)), size)


def signature(values: np.ndarray) -> np.ndarray:
    """Smallest values under all permutations, then the largest ones."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(values), _STEP):
        moved = values[None, at : at + _STEP] * _MULTIPLY[:, None]
        moved += _ADD[:, None]
        moved ^= moved >> np.uint64(32)
        np.minimum(low, moved.min(axis=1), out=low)
        np.maximum(high, moved.max(axis=1), out=high)
    return np.concatenate((low, high))


def bands(values: np.ndarray) -> np.ndarray:
    """One hash per band of the signature; each names its band, too."""
    rows = signature(values).reshape(-1, ROWS)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the similarity of two sorted sets is at least ``percent`` hundredths, in integers."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int(np.count_nonzero(b[at] == a))
    return 100 * common >= percent * (len(a) + len(b) - common)


def possible_pairs(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each set of ``left`` the sets of ``right`` that may be similar to it.

    Shingles are ordered by how many of the sets hold them, the rarest first. Of n shingles a similar set holds
    at least ``percent`` hundredths, so it holds one of the first n - ceil(n * percent / 100) + 1, and the first such
    one that both hold is among these of either. What everyone holds, like a template, is never among them unless
    a set has little else. Sizes must fit, too.
    """
    if not left or not right:
        return
    every, counts = np.unique(np.concatenate([*left, *right]), return_counts=True)

    def rarest(values: np.ndarray) -> np.ndarray:
        at = np.searchsorted(every, values)
        n = len(values) + (-len(values) * percent) // 100 + 1
        return at[np.lexsort((at, counts[at]))[:n]]

    firsts = [rarest(values) for values in right]
    owners = np.repeat(np.arange(len(right)), [len(f) for f in firsts])
    held = np.concatenate(firsts)
    order = np.argsort(held, kind="stable")
    owners, held = owners[order], held[order]
    sizes = np.array([len(values) for values in right])
    for i, values in enumerate(left):
        mine = rarest(values)
        begin, end = np.searchsorted(held, mine, "left"), np.searchsorted(held, mine, "right")
        found = np.unique(np.concatenate([owners[b:e] for b, e in zip(begin, end)]))
        small, large = np.minimum(sizes[found], len(values)), np.maximum(sizes[found], len(values))
        yield i, found[100 * small >= percent * large]


def _sketches(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    source = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    fields = T.StructType(
        [
            source.schema["key"],
            T.StructField("n_shingles", T.LongType()),
            T.StructField("same", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, same, found = [], [], []
            for content in batch.column("text"):
                values = shingle_set(content.as_py(), size)
                counts.append(len(values))
                same.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
                found.append(bands(values).view(np.int64) if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(counts, pa.int64()),
                    pa.array(same, pa.binary()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["key", "n_shingles", "same", "bands"],
            )

    return source.mapInArrow(sketch, fields)


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """The full sets of the documents in ``wanted`` (node): node, values."""
    # The nodes are hashed, so that whole texts are not sorted to meet them.
    source = docs.select(F.col(key).alias("node"), whole_text(text).alias("text")).join(wanted.hint("shuffle_hash"), "node")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [shingle_set(t.as_py(), size).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(values, pa.binary())], ["node", "values"])

    return source.mapInArrow(compute, T.StructType([source.schema["node"], T.StructField("values", T.BinaryType())]))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked."""
    left = sets.select(F.col("node").alias("a"), F.col("values").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("values").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [
                linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                for x, y in zip(batch.column("x"), batch.column("y"))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(hits, pa.bool_()))

    return joined.mapInArrow(confirm, T.StructType([joined.schema["a"], joined.schema["b"]]))


def _remaining(members: DataFrame, known: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that meet in a bucket and whose pairs have not all been compared.

    ``members``: band, node, n_shingles, centre, filled. In a bucket of two, the one pair has been compared.
    """
    placed = (
        members.where(F.col("filled") > 2)
        .join(known.withColumnRenamed("component", "_component"), "node", "left")
        .select("band", "node", "n_shingles", F.coalesce("_component", "node").alias("component"))
    )
    parts = placed.groupBy("band", "component").agg(
        F.count("*").alias("n"), (8 * F.sum("n_shingles")).alias("bytes"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h")
    )
    largest = F.struct("n", "component")
    mixed = (
        parts.groupBy("band")
        .agg(
            F.max_by(F.struct("component", "n", "bytes"), largest).alias("main"),
            F.sum("n").alias("n"),
            F.sum("bytes").alias("bytes"),
            F.sum("h").alias("h"),
            F.count("*").alias("k"),
        )
        .where(F.col("k") > 1)
    )
    # Buckets with the same members need to be looked at once.
    mixed = mixed.groupBy("n", "bytes", "h").agg(F.min_by(F.struct("band", "main"), "band").alias("first"))
    mixed = mixed.select("first.*", "n", "bytes")
    outer = F.ceil((F.col("bytes") - F.col("main.bytes")) / BLOCK_BYTES)
    pairs = F.ceil((F.col("n") - F.col("main.n")) / outer) * F.col("n")
    inner = F.greatest(F.ceil(F.col("bytes") / BLOCK_BYTES), F.ceil(pairs / BLOCK_PAIRS))
    mixed = mixed.select(
        "band", F.col("main.component").alias("main"), outer.cast("int").alias("outer"), inner.cast("int").alias("inner")
    )
    at = placed.join(mixed, "band")
    own = lambda count: F.pmod(F.xxhash64("node", F.lit(7)), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    outside = at.where(F.col("component") != F.col("main")).select(
        "band", "node", "component", own("outer").alias("block"), every("inner").alias("slice")
    )
    inside = at.select("band", "node", "component", every("outer").alias("block"), own("inner").alias("slice"))

    kind = members.schema["node"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        mine, theirs = (
            [(r["node"], r["component"], np.frombuffer(r["values"], np.uint64)) for r in side.select(["node", "component", "values"]).to_pylist()]
            for side in (left, right)
        )
        for i, possible in possible_pairs([m[2] for m in mine], [t[2] for t in theirs], percent):
            done = {mine[i][1]}
            for j in possible:
                node, component, values = theirs[j]
                # One link to another component tells all that further ones would.
                if component not in done and linked(mine[i][2], values, percent):
                    done.add(component)
                    a.append(mine[i][0])
                    b.append(node)
        return pa.table({"a": pa.array(a, left.schema.field("node").type), "b": pa.array(b, left.schema.field("node").type)})

    by = ("band", "block", "slice")
    # Both sides come from the same tables: new names for their columns keep them apart.
    columns = [F.col(c).alias(c) for c in (*by, "node", "component", "values")]
    left, right = (side.join(sets, "node").select(*columns).groupBy(*by) for side in (outside, inside))
    return left.cogroup(right).applyInArrow(compare, schema)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``key``, n_shingles, component_id, kept.

    A document's set holds its distinct shingles of ``size`` words (runs without blanks, A-Z in
    lower case); with fewer words, the whole sequence. Documents are linked if 100 times the
    intersection is at least ``percent`` times the union. ``component_id`` is the smallest key
    that can be reached over links, and ``kept`` says whether that is the row's own.

    Texts of any length are taken in whole. Without words (null and empty texts) n_shingles is 0 and the document is linked with nothing. A
    row without a key is linked with nothing either; its component is null and it is kept. Repeated
    rows share a result. Rows with one key and different texts are judged each by its own text;
    classes of texts with the same smallest key count as linked. An empty table gives an empty
    table. Other columns are not carried along: join on ``key``.
    """
    sketches = write_through(_sketches(docs, key, text, size), "sketches")
    known = sketches.where(F.col("same").isNotNull() & F.col("key").isNotNull())
    # Equal sets have equal bands, so any will do.
    whole = [F.any_value(c).alias(c) for c in ("n_shingles", "bands")]
    classes = write_through(known.groupBy("same").agg(F.min("key").alias("node"), *whole), "classes")
    entries = classes.select("node", "n_shingles", F.explode("bands").alias("band"))
    buckets = entries.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("filled")).where(F.col("filled") > 1)
    members = write_through(entries.join(buckets, "band"), "bucket-members")
    sets = write_through(_sets(docs, members.select("node").distinct(), key, text, size), "sets")

    pairs = members.where(F.col("node") != F.col("centre"))
    pairs = pairs.select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    links = write_through(_confirmed(pairs, sets, percent), "confirmed-links")
    found = components(links)
    more = write_through(_remaining(members, found, sets, percent), "further-links")
    # Links inside known components are represented by links to their names.
    settled = found.select(F.col("node").alias("a"), F.col("component").alias("b")).where(F.col("a") != F.col("b"))
    final = components(settled.unionByName(more))

    named = classes.select("same", "node").join(final, "node", "left")
    named = named.select("same", F.coalesce("component", "node").alias("component"))
    joined = sketches.drop("bands").join(named, "same", "left")
    # A null key has no class of its own; texts without words name themselves.
    component = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    kept = component.eqNullSafe(F.col("key"))
    return joined.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"), kept.alias("kept"))
