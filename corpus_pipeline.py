"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Toxic documents go, lines that many documents share go except in the last of them, one document of
each group of near duplicates stays, sources are brought to their target weights, and what is left is
packed into sequences. All stages but the last return the columns that they were given.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.llm.columns import pack_row, whole_text
from framewise.llm.line_dedup import drop_shared_lines
from framewise.llm.mixing import mix_sources
from framewise.llm.near_dedup import near_duplicates
from framewise.llm.packing import pack
from framewise.llm.registry import END_ID, MIX_ENTROPY, MIX_REPEATS, byte_vocabulary, held_out, table
from framewise.llm.token_counts import count_tokens
from framewise.llm.toxicity import score_toxicity, train
from framewise.settings import run_dir, shared_dir, write_through

#: The toxicity and near-duplicate stages cannot be expressed in SQL.
ORACLE_SQL = None


#: What goes to a Python worker at a time. Rows hold whole texts, and an executor's workers hold several batches.
BATCH = "4m"
#: Bytes of a row group of what stages write. A task holds its row group in memory until that is full, as long as the
#: whole of what it writes if groups are as large as by default (128 MB).
ROW_GROUP = 8 << 20


def _bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
    spark.conf.set("parquet.block.size", str(ROW_GROUP))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents predicted to be toxic. The model is learnt from labelled ones among ``docs``.

    Null and empty texts have nothing toxic and stay; texts are scored in whole, and repeated rows alike.
    """
    _bounded(spark)
    model = train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), ~held_out())
    return score_toxicity(docs, model).where(F.col("predicted") == 0).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that at least three documents share, but for their last holder.

    Every document stays, if with an empty text; null texts and such without lines of 20 code points
    are as they were. Rows without an id take no part and stay as they are; repeated rows are one document.
    """
    _bounded(spark)
    # Not two: pairs of near duplicates must reach the next stage with the lines that they share.
    return drop_shared_lines(docs, documents=3).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by five-word shingles at 0.8.

    Documents without words, or with a null id, are in no group and stay. What stays is also counted in
    tokens, as packing has them, for the next stage.
    """
    _bounded(spark)
    found = near_duplicates(docs.select("doc_id", "text"))
    dropped = found.where(~F.col("kept")).select("doc_id").distinct()
    # Rows without an id are in no group and stay. The ids are hashed, so that whole texts are not sorted to meet them.
    kept = write_through(docs.join(dropped.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns), "near-kept")
    counted = count_tokens(kept.select("text"), byte_vocabulary())
    counted.select(_text_key("text"), "n_tokens").write.mode("overwrite").parquet(_counts_dir(spark))
    return kept


def _counts_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/pipeline-token-counts-{spark.sparkContext.applicationId}"


def _text_key(text: str) -> Column:
    return F.sha2(whole_text(text), 256).alias("_text_key")


def _token_counts(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """(_text_key, _counted): the number of tokens of each text of ``texts`` (column ``text``).

    What the stage before has counted is read; texts that it did not see, as when mixing is run by itself, are
    counted now.
    """
    try:
        known = spark.read.schema("_text_key string, n_tokens long").parquet(_counts_dir(spark)).dropDuplicates(["_text_key"])
    except AnalysisException:
        known = spark.range(0).select(F.lit("").alias("_text_key"), F.col("id").alias("n_tokens"))
    keyed = texts.where(whole_text("text") != "").select(_text_key("text"), "text")
    missing = keyed.join(known, "_text_key", "left_anti")
    if not missing.isEmpty():
        now = count_tokens(missing.dropDuplicates(["_text_key"]), byte_vocabulary()).select("_text_key", "n_tokens")
        known = known.unionByName(write_through(now, "mix-tokens"))
    return known.withColumnRenamed("n_tokens", "_counted")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights: every document at least once, those of small sources more often.

    Weights are of tokens as packing counts them, each document's end among them, so null and empty texts
    count one. A null source is a source; repeated rows are drawn alike, but for the block in which a
    source's budget ends.
    """
    _bounded(spark)
    # The row is one column, so that no name can clash.
    # Empty texts have no tokens, and may be many: each goes by a key of its own, which finds nothing.
    alone = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    own = F.when(whole_text("text") != "", _text_key("text")).otherwise(alone)
    rows = docs.select(pack_row(docs, "_all"), own.alias("_text_key"))
    # Counts are small and of distinct texts: they are hashed, so that whole texts are not sorted to meet them.
    counted = rows.join(_token_counts(spark, docs).hint("shuffle_hash"), "_text_key", "left")
    counted = counted.withColumn("_counted", F.coalesce("_counted", F.lit(0)))
    counted = write_through(counted, "mix-rows")
    tokens = F.col("_counted") + 1
    return mix_sources(counted, "_all.doc_id", "_all.source", tokens, MIX_ENTROPY, MIX_REPEATS).select("_all.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2,048 tokens: one row per piece of a document.

    Null and empty texts are a piece of one id, their end; longer texts than a sequence have several pieces.
    """
    _bounded(spark)
    return pack(docs, byte_vocabulary(), END_ID)


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("near dedup", near_dedup), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, folder = table(spark, sf_dir, "documents"), run_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
