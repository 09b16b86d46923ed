"""Token counts: two-tier lookup of pre-token lengths inside the tasks that read the texts.

Tier one is a broadcast table of the most frequent pre-tokens with their lengths, tier two each
worker's memory of the pre-tokens it has encoded. No pre-token is ever shuffled: the table comes
from summaries of bounded size, one per task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.bpe import Encoder, read_vocabulary, worker_encoder
from reviewloom.llm.text import shelve

FREQUENT = 32_768  # entries of the broadcast table, about 1 MB
PER_TASK = 8_192  # pre-tokens a task reports
PER_COUNTER = 100_000  # distinct pre-tokens a task counts before it forgets the rarer half
LIMIT = 2048


def frequent_pre_tokens(docs: DataFrame, vocabulary, most: int = FREQUENT) -> list[str]:
    """About the most frequent pre-tokens of all texts. Which ones is a matter of speed only."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, counts = worker_encoder(vocabulary), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(encoder.pre_tokens(text or "") or ())
                if len(counts) > PER_COUNTER:
                    counts = Counter(dict(counts.most_common(PER_COUNTER // 2)))
        top = counts.most_common(PER_TASK)
        yield pa.RecordBatch.from_pydict(
            {"token": [t for t, _ in top], "n": [n for _, n in top]},
            schema=pa.schema([("token", pa.string()), ("n", pa.int64())]))

    found = docs.select("text").mapInArrow(summaries, "token string, n long")
    top = found.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token")
    return [r["token"] for r in top.limit(most).collect()]


def token_counts(docs: DataFrame, vocabulary_path: str, *, limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    Needs ``text``; columns with one of the new names are replaced, all others stay. A null text
    counts as empty: 0 bytes, 0 tokens. Each row is counted by itself, so repeated rows, null ids
    and ties need no rule. Texts of any length are counted whole.
    """
    context = docs.sparkSession.sparkContext
    vocabulary = context.broadcast(read_vocabulary(vocabulary_path))
    top = frequent_pre_tokens(docs, vocabulary)
    lengths = Encoder(vocabulary.value).lengths(top)
    frequent = context.broadcast(dict(zip(top, lengths, strict=True)))

    @F.pandas_udf("long")
    def count(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = worker_encoder(vocabulary, frequent)
        for texts in series:
            yield pd.Series(list(encoder.lengths(texts.tolist())), dtype="int64")

    text = F.coalesce(F.col("text"), F.lit(""))
    rows, back = shelve(docs, ["text"], ["n_bytes", "n_tokens", "over_limit"])
    return back(rows.withColumns({
        "n_bytes": F.octet_length(text).cast("long"), "n_tokens": count(text),
    }).withColumn("over_limit", F.col("n_tokens") > limit))
