"""Exact duplicates by an extendible-hash index on shared files. DataFrame operations only.

The directory comes first, from the numbers of distinct hashes; buckets, which are ranges of hashes, are then dealt to
owner tasks, which compare bytes. Every row finds its entry in the index by bucket, hash, length and SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm.columns import pack_row, whole_text, without
from framewise.settings import write_through

#: Entries of a bucket before the directory is doubled to split it.
CAPACITY = 1 << 12
#: Bytes of the texts of one hash before they overflow to further pages of their bucket, each with an owner of its own.
PAGE_BYTES = 4 << 20
#: A directory, or a list of overflowing hashes, of more rows than this is joined by a shuffle instead of being
#: sent to every task (some fifty bytes a row).
SENT_ROWS = 200_000

_CHAIN = ("_hash", "_sha", "_bytes")


def _prefix(hash_: str, depth: int) -> Column:
    """The leading ``depth`` bits of a 64-bit hash, as a number from 0 on."""
    return F.shiftrightunsigned(hash_, 64 - depth) if depth else F.lit(0).cast("long")


def _sent(table: DataFrame) -> DataFrame:
    """``table``, which has been written, to be sent to all tasks if it is small."""
    return F.broadcast(table) if table.count() <= SENT_ROWS else table


def directory(hashes: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """Which bucket each prefix of hash bits belongs to: (prefix, bucket), and the number of bits.

    ``hashes`` has each hash once. The directory doubles, one more bit a time, for as long as a bucket holds more than
    ``capacity`` of them; fewer bits than as many as the buckets that are needed at least are not tried. A bucket that
    was not overfull earlier stays one, for several prefixes. It is named by the number of its bits and these.
    """
    total, depth = hashes.count(), 0
    while total > capacity << depth:
        depth += 1
    while True:
        counts = write_through(hashes.groupBy(_prefix("_hash", depth).alias("prefix")).agg(F.count("*").alias("n")), "index-counts")
        if (counts.agg(F.max("n")).first()[0] or 0) <= capacity:
            break
        depth += 1
    steps = counts.select("prefix", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
    bits = F.expr(f"if(depth = 0, 0L, shiftrightunsigned(prefix, {depth} - depth))")
    steps = steps.withColumn("bucket", F.concat_ws(":", "depth", bits))
    filled = steps.groupBy("bucket").agg(F.sum("n").alias("filled")).where(F.col("filled") <= capacity)
    fitting = steps.join(filled, "bucket")
    return fitting.groupBy("prefix").agg(F.min_by("bucket", "depth").alias("bucket")), depth


def dealt_to_owners(entries: DataFrame, capacity: int = CAPACITY, page_bytes: int = PAGE_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """``entries`` with ``bucket`` and ``page``, each in the partition of its owner; and the directory.

    A bucket is a range of hashes and has one owner. Rows of one hash, be they copies or not, cannot be
    split by more bits: from ``page_bytes`` on they overflow to further pages.
    """
    length = F.octet_length("_text").cast("long")
    counts = write_through(entries.groupBy("_hash").agg(F.sum(length).alias("_n")), "index-hashes")
    prefixes, depth = directory(counts.select("_hash"), capacity)
    prefixes = write_through(prefixes, "index-directory")
    pages = F.ceil(F.col("_n") / page_bytes).alias("_pages")
    hot = write_through(counts.where(F.col("_n") > page_bytes).select("_hash", pages), "index-overflow")
    owned = entries.withColumn("_no", F.monotonically_increasing_id()).join(_sent(hot), "_hash", "left")
    page = F.coalesce(F.pmod("_no", "_pages"), F.lit(0)).alias("page")
    owned = owned.select(*entries.columns, page, _prefix("_hash", depth).alias("prefix"))
    owned = owned.join(_sent(prefixes), "prefix").drop("prefix")
    return owned.repartition("bucket", "page"), prefixes, depth


def build_index(entries: DataFrame, capacity: int = CAPACITY, page_bytes: int = PAGE_BYTES) -> tuple[DataFrame, DataFrame, int]:
    """The index of ``entries`` (_key, _text, _hash) and its directory, as shared files, with the directory's bits.

    An owner compares the bytes of entries with one hash, so that equal texts become one entry of the index and
    different ones a chain, in which length and SHA-256 tell them apart. Pages of one hash are put together by these.
    """
    owned, prefixes, depth = dealt_to_owners(entries, capacity, page_bytes)
    compared = owned.groupBy("bucket", "page", "_hash", "_text").agg(F.max("_key").alias("_keep"), F.count("*").alias("_size"))
    sha, length = F.sha2("_text", 256).alias("_sha"), F.octet_length("_text").alias("_bytes")
    records = write_through(compared.select("bucket", "_hash", sha, length, "_keep", "_size"), "index-records")
    records = records.groupBy("bucket", *_CHAIN).agg(F.max("_keep").alias("_keep"), F.sum("_size").alias("_size"))
    chain = Window.partitionBy("bucket", "_hash").orderBy("_bytes", "_sha")
    return write_through(records.withColumn("_place", F.row_number().over(chain)), "index"), prefixes, depth


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, page_bytes: int = PAGE_BYTES
) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``, a row for each input row.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the
    largest ``key`` value stays. Rows without a ``key`` value count in ``group_size`` and stay
    only if no row of their group has one (``keep_id`` is null then). Repeated rows that share
    the largest value all stay, as nothing tells them apart. Input columns with the names of the
    results are replaced; other columns pass through. Texts of any length are compared in whole. An empty table gives
    an empty table.
    """
    docs = without(docs, "keep_id", "group_size", "kept", "text_sha256")
    rows = docs.select(pack_row(docs), F.col(key).alias("_key"), whole_text(text).alias("_text"))
    rows = rows.withColumn("_hash", F.xxhash64("_text"))
    index, prefixes, depth = build_index(rows.select("_key", "_text", "_hash"), capacity, page_bytes)
    probes = rows.withColumns({"_sha": F.sha2("_text", 256), "_bytes": F.octet_length("_text"), "prefix": _prefix("_hash", depth)}).drop("_text")
    found = probes.join(_sent(prefixes), "prefix").drop("prefix").join(index, ["bucket", *_CHAIN])
    return found.select(
        *[F.col(f"_row.`{c}`") for c in docs.columns],
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_key").eqNullSafe(F.col("_keep")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
