"""Token counts of whole texts: huge texts in overlapping chunks, spliced where both agree."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.columns import whole_text, without
from framewise.llm.encoding import encoder


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    A null text counts as empty: 0 bytes, 0 tokens. Rows are independent of each other, so
    nulls elsewhere, repeated rows and further columns pass through; input columns with the
    names of the three results are replaced. An empty table gives an empty table.

    ``vocabulary`` is the path of a ``tokenizers`` file that every worker can open. Special
    strings inside texts count as the library's default has it. Memory is bounded by the
    longest text, not by its encoding: see ``encoding``.
    """

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids = encoder(vocabulary).ids
        for texts in batches:
            yield pd.Series([len(ids(t)) for t in texts], dtype="int64")

    return (
        without(docs, "n_bytes", "n_tokens", "over_limit")
        .withColumn("n_bytes", F.octet_length(whole_text(text)).cast("long"))
        .withColumn("n_tokens", tokens(whole_text(text)))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
