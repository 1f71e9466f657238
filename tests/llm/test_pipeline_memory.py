"""What a stage of the pipeline holds in an executor's memory."""

import hashlib
import re

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from framewise import settings
from framewise.llm import registry
from framewise.llm.near_dedup import near_duplicates
from framewise.llm.packing import pack
from framewise.llm.toxicity import train


@pytest.fixture
def docs(docs_of):
    return docs_of([f"document {i} has words of its own, {i * i} and {i * i * i} among them" for i in range(60)])


@pytest.fixture
def plans(monkeypatch, spark):
    """The plans of what is written through, by name."""
    seen = {}

    def write_through(df, name):
        seen[name] = df._jdf.queryExecution().executedPlan().toString()
        return settings.write_through(df, name)

    for module in ("corpus_pipeline", "framewise.llm.near_dedup"):
        monkeypatch.setattr(f"{module}.write_through", write_through)
    # Else tables as small as these are sent to every task.
    monkeypatch.setattr(corpus_pipeline, "_bounded", lambda _: None)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield seen
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_whole_texts_are_not_sorted_to_be_joined(spark, docs, plans, vocabulary):
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert corpus_pipeline.mixing(spark, kept, "").select("doc_id").distinct().count() == 60
    for name in ("sets", "near-kept", "mix-rows"):
        # The outermost is that with the texts.
        assert re.search(r"\w+Join", plans[name]).group() == "ShuffledHashJoin", name


def test_sets_of_repeated_rows_without_ids(docs_of):
    words = "one two three four five six seven eight nine ten"
    found = near_duplicates(docs_of([words, words, words, None, words + " eleven"], [3, 3, None, 4, 1])).collect()
    assert sorted((str(r["doc_id"]), r["component_id"], r["kept"]) for r in found) == [
        ("1", 1, True), ("3", 1, False), ("3", 1, False), ("4", 4, True), ("None", None, True),
    ]


def test_row_groups_are_bounded(spark, tmp_path, docs_of, monkeypatch, vocabulary):
    monkeypatch.setattr(corpus_pipeline, "ROW_GROUP", 1 << 18)
    # Digests, which don't compress much.
    docs = docs_of([" ".join(hashlib.sha256(b"%d-%d" % (i, j)).hexdigest() for j in range(40)) for i in range(600)]).coalesce(1)
    before = spark.conf.get("parquet.block.size", None)
    try:
        corpus_pipeline.mixing(spark, docs, "").coalesce(1).write.parquet(f"{tmp_path}/mixed")
    finally:
        spark.conf.unset("parquet.block.size") if before is None else spark.conf.set("parquet.block.size", before)
    sizes = [pq.ParquetFile(p).metadata for p in tmp_path.glob("mixed/*.parquet")]
    assert max(m.num_row_groups for m in sizes) > 2


def test_no_python_workers_for_rows_of_the_driver(spark, tmp_path, docs, monkeypatch, vocabulary):
    """Lists of rows are written anew by Python workers on the executors; Arrow tables are not."""
    given = []
    create = type(spark).createDataFrame
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")

    def noted(self, data, *a, **b):
        given.append(type(data).__module__)
        return create(self, data, *a, **b)

    monkeypatch.setattr(type(spark), "createDataFrame", noted)
    train(docs.select("doc_id", "text"), labels, labels["doc_id"] >= 0)
    assert pack(docs, vocabulary, registry.END_ID).count() == 60
    assert corpus_pipeline.mixing(spark, docs, "").count() >= 60
    assert given and all(m.startswith("pyarrow") for m in given)


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert train(docs.select("doc_id", "text"), none, none["doc_id"] >= 0).weights is None
