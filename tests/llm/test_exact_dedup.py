import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from framewise.llm.exact_dedup import _prefix, build_index, dealt_to_owners, directory, exact_duplicates


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    out = []
    for r in rows:
        group = groups[r["text"] or ""]
        keep = max((k for k in group if k is not None), default=None)
        out.append((r["doc_id"], keep, len(group), r["doc_id"] == keep, hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_odd_texts_and_any_directory(odd_docs):
    for capacity in (1, 3, 1 << 16):
        assert found(exact_duplicates(odd_docs, capacity=capacity)) == brute(odd_docs.collect())


def test_columns_pass_through(odd_docs):
    clash = odd_docs.withColumns({"bucket": F.lit(1), "prefix": F.lit(2), "kept": F.lit(3), "_hash": F.lit(4), "KEEP_ID": F.lit(5)})
    columns = exact_duplicates(clash).columns
    assert columns == ["doc_id", "text", "lang", "source", "bucket", "prefix", "_hash", "keep_id", "group_size", "kept", "text_sha256"]
    assert found(exact_duplicates(clash)) == brute(odd_docs.collect())
    assert exact_duplicates(clash.limit(0)).collect() == []


def test_group_of_a_third(docs_of):
    docs = docs_of(["copy"] * 400 + [f"text {i}" for i in range(800)])
    assert found(exact_duplicates(docs, capacity=16)) == brute(docs.collect())


def test_chain_of_texts_with_one_hash(docs_of):
    rows = docs_of(["a", "b", "b", "c"]).select(F.col("doc_id").alias("_key"), F.col("text").alias("_text"), F.lit(5).cast("long").alias("_hash"))
    index, _, _ = build_index(rows)
    assert sorted((r["_keep"], r["_size"]) for r in index.collect()) == [(0, 1), (2, 2), (3, 1)]
    assert sorted(r["_place"] for r in index.collect()) == [1, 2, 3]


def test_buckets_hold_no_more_than_their_capacity(spark):
    index = spark.range(5000).select(F.xxhash64("id").alias("_hash"))
    for capacity in (1, 50, 2000, 5000):
        table, depth = directory(index, capacity)
        filled = index.select(_prefix("_hash", depth).alias("prefix")).join(table, "prefix").groupBy("bucket").count().collect()
        assert sum(r["count"] for r in filled) == 5000 and max(r["count"] for r in filled) <= capacity
        # No bucket was split that was not overfull.
        size = {tuple(map(int, r["bucket"].split(":"))): r["count"] for r in filled}
        assert all(size[d, b] + size[d, b ^ 1] > capacity for d, b in size if (d, b ^ 1) in size)
        assert (len(filled) == 1) == (capacity == 5000)


def test_directory_doubles_as_far_as_it_takes(spark):
    """Hashes that only differ in their last bits: more doublings than a directory could have entries."""
    rows = spark.createDataFrame([(i,) for i in range(8)], "_hash long")
    table, depth = directory(rows, 1)
    assert depth == 64 and sorted(r["prefix"] for r in table.collect()) == list(range(8))


@pytest.fixture
def no_merging(spark):
    """Small partitions of a shuffle stay as they are."""
    option = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(option, "false")
    yield
    spark.conf.unset(option)


def test_owners_hold_buckets_and_a_hot_text_has_several(spark, docs_of, no_merging):
    docs = docs_of(["copy"] * 400 + [f"text {i}" for i in range(800)])
    entries = docs.select(F.col("doc_id").alias("_key"), F.col("text").alias("_text"), F.xxhash64("text").alias("_hash"))
    owned, _, depth = dealt_to_owners(entries, 50, 400)
    rows = owned.select("bucket", "page", "_text", F.spark_partition_id().alias("task")).collect()
    tasks = {}
    for r in rows:
        tasks.setdefault((r["bucket"], r["page"]), set()).add(r["task"])
    assert len(rows) == 1200 and depth > 3 and all(len(t) == 1 for t in tasks.values())
    assert len({r["page"] for r in rows if r["_text"] == "copy"}) == 4 and {r["page"] for r in rows if r["_text"] != "copy"} <= {0}
    # Without a directory there is one bucket, and it is dealt otherwise.
    whole, _, none = dealt_to_owners(entries, 5000, 50_000)
    assert none == 0 and {r["task"] for r in whole.select(F.spark_partition_id().alias("task")).collect()} != {r["task"] for r in rows}
    for capacity, page_bytes in ((50, 400), (50, 50_000), (5000, 400), (5000, 50_000)):
        assert found(exact_duplicates(docs, capacity=capacity, page_bytes=page_bytes)) == brute(docs.collect())
