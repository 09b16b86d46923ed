"""Importance resampling towards a target, with texts cut into lines.

Words and word pairs are hashed into buckets, and a bucket's gain is the log ratio of its share in
the target to its share in the corpus. A text is cut at line feeds, which separate words anyway.
Equal lines are brought together first: the features of a line are counted once and multiplied by
its occurrences. A pair whose words lie in different lines belongs to no line; such pairs are
counted from the lines' first and last words and added. A document's weight is its mean gain, its
score adds Gumbel noise drawn from the id, and the highest scores are a sample without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reviewloom.llm.text import shelve, stored

BUCKETS = 10_000
SEED = 7
PERCENT = 25
MIN_WORDS = 20
BLOCK_ROWS = 1 << 17
REMEMBERED = 1 << 25  # bytes of lines whose gains a worker remembers
LINES_AT_ONCE = 4096
NEW = ["n_features", "weight", "score", "rank"]

# bytes of words: digits, letters and all of UTF-8 beyond ASCII; A-Z become a-z, others a blank
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def line_words(line: bytes) -> list[bytes]:
    return line.translate(_FOLD).split()


def features(words: list[bytes]) -> np.ndarray:
    """CRC-32 of every word and of every pair of neighbours joined by a blank."""
    single = list(map(crc32, words))
    # the pair's checksum goes on from its first word's
    pairs = map(crc32, [b" " + w for w in words[1:]], single)
    return np.fromiter((*single, *pairs), "int64", max(2 * len(words) - 1, 0))


def crossings(ends: list[tuple[bytes, bytes]]) -> np.ndarray:
    """CRC-32 of the pairs between one line's last word and the next line's first word; ``ends``
    holds first and last word of each line that has words."""
    pairs = [a[1] + b" " + b[0] for a, b in zip(ends, ends[1:], strict=False)]
    return np.fromiter(map(crc32, pairs), "int64", len(pairs))


def _histogram(counts: np.ndarray) -> pa.RecordBatch:
    met = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array(met.astype("int32")), pa.array(counts[met])], names=["bucket", "n"])


def distinct_lines(texts: DataFrame) -> DataFrame:
    """``line`` and its ``occurrences`` over all rows of ``text``. Equal lines are added up in the
    tasks that read them first, so a frequent line is one row per task."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    return lines.groupBy("line").agg(F.count("*").alias("occurrences"))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n``: features of all rows of ``text``, repeats counted. A task gives one
    table of ``buckets`` numbers."""

    def of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, "int64")
        for batch in batches:
            lines = batch.column(0).to_pylist()
            times = batch.column(1).to_numpy()
            for at in range(0, len(lines), LINES_AT_ONCE):
                found = [features(line_words(x.encode())) for x in lines[at:at + LINES_AT_ONCE]]
                n = np.repeat(times[at:at + LINES_AT_ONCE], [len(f) for f in found])
                np.add.at(total, np.concatenate(found) % buckets, n)
        yield _histogram(total)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, "int64")
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = [w for w in map(line_words, text.encode().split(b"\n")) if w]
                np.add.at(total, crossings([(w[0], w[-1]) for w in words]) % buckets, 1)
        yield _histogram(total)

    inside = distinct_lines(texts).mapInArrow(of_lines, "bucket int, n long")
    between = texts.filter(F.contains("text", F.lit("\n"))).select("text").mapInArrow(
        across, "bucket int, n long")
    return inside.unionAll(between).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket in thousandths, rounded down: ``buckets`` numbers at the driver."""
    counts = {}
    for name, texts in (("s", corpus), ("t", target)):
        counts[name] = np.zeros(buckets, "int64")
        for bucket, n in bucket_counts(texts, buckets).collect():
            counts[name][bucket] = n
    n_s, n_t = (float(counts[k].sum() + buckets) for k in "st")
    return [math.floor(1000 * math.log((t + 1) * n_s / ((s + 1) * n_t)))
            for s, t in zip(counts["s"].tolist(), counts["t"].tolist(), strict=True)]


class LineGains(dict):
    """Line to (words, gain of its features, first word, last word); forgets when full."""

    def __init__(self, gains: list[int]):
        super().__init__()
        self.gains, self.size = np.array(gains, "int64"), 0

    def total(self, hashes: np.ndarray) -> int:
        return int(self.gains[hashes % len(self.gains)].sum())

    def __missing__(self, line: bytes) -> tuple:
        words = line_words(line)
        value = (len(words), self.total(features(words)), *(words[:1] + words[-1:]))
        if self.size > REMEMBERED:
            self.clear()
            self.size = 0
        self.size += 2 * len(line) + 300
        self[line] = value
        return value

    def of(self, text: str | None) -> tuple[int, int, int]:
        """Words, features and mean gain, rounded down, of a text."""
        lines = [x for x in map(self.__getitem__, (text or "").encode().split(b"\n")) if x[0]]
        n_words = sum(x[0] for x in lines)
        n = max(2 * n_words - 1, 0)
        gain = sum(x[1] for x in lines) + self.total(crossings([x[2:] for x in lines]))
        return n_words, n, gain // n if n else 0


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the id; a null id counts as empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scores: DataFrame, percent: int, min_words: int) -> DataFrame:
    """``_row`` and ``rank`` of the drawn rows, from ``_row``, ``doc_id``, ``n_words``, ``score``.

    Scores are whole thousandths in a narrow range, so the table of distinct scores is small
    whatever the corpus: adding up its counts gives each score's first rank. Only the rows of one
    score are ordered, by id, and repeats of one id are numbered in blocks of ``BLOCK_ROWS`` rows.
    """
    able = scores.filter(F.col("n_words") >= min_words).select(
        "_row", "doc_id", "score", F.floor(F.col("_row") / F.lit(BLOCK_ROWS)).alias("_block"))
    per_score = able.groupBy("score").agg(F.count("*").alias("_n"))
    ahead = W.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    firsts = per_score.withColumns({
        "_before": F.coalesce(F.sum("_n").over(ahead), F.lit(0)),
        "_drawn": F.floor(F.sum("_n").over(W.partitionBy()) * F.lit(percent) / F.lit(100)),
    }).filter("_before < _drawn").drop("_n")
    near = able.join(firsts, "score")
    keys = ["score", "doc_id", "_block"]
    blocks = near.groupBy(*keys).agg(F.count("*").alias("_n"))
    inside = W.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "_block")
    starts = blocks.select(*[F.col(k).alias(f"_k{k}") for k in keys], F.coalesce(
        F.sum("_n").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k{k}"))
    number = F.row_number().over(W.partitionBy(*keys).orderBy("_row"))
    return near.join(starts, same).select(
        "_row", (F.col("_before") + F.col("_start") + number).alias("rank"), "_drawn",
    ).filter("rank <= _drawn").drop("_drawn")


def _weighed(rows: DataFrame, gains: list[int], seed: int) -> DataFrame:
    """``_row``, ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``, stored."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LineGains(gains)
        for batch in batches:
            found = [known.of(t) for t in batch.column(2).to_pylist()]
            columns = zip(*found, strict=True) if found else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in columns]],
                names=["_row", "doc_id", "n_words", "n_features", "weight"])

    found = rows.select("_row", "doc_id", "text").mapInArrow(
        weigh, "_row long, doc_id long, n_words long, n_features long, weight long")
    return stored(
        found.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")


def importance_scores(
    docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS,
    seed: int = SEED, buckets: int = BUCKETS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank``,
    which is null where the row is not drawn.

    Needs ``doc_id`` (a whole number) and ``text`` in ``docs`` and ``text`` in ``target``; other
    columns are not used. A null or empty text has no features and weight 0; texts of fewer than
    ``min_words`` words are scored but never drawn. Rows that repeat an id share its noise and are
    drawn each by itself; a null id has the noise of an empty text and comes last among ties. Of
    repeated rows that tie, any may come first. An empty target counts 0 in every bucket. No rows
    in, no rows out.
    """
    gains = bucket_gains(docs.select("text"), target.select("text"), buckets)
    scored = _weighed(docs.withColumn("_row", F.monotonically_increasing_id()), gains, seed)
    ranks = ranked(scored, percent, min_words)
    return scored.join(ranks, "_row", "left").select("doc_id", *NEW)


def importance_sample(
    docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS,
    seed: int = SEED, buckets: int = BUCKETS,
) -> DataFrame:
    """The rows of ``docs`` that are drawn, whole, with ``n_features``, ``weight``, ``score`` and
    ``rank``; columns with one of these names are replaced. Rows are handled as in
    ``importance_scores``."""
    gains = bucket_gains(docs.select("text"), target.select("text"), buckets)
    rows, back = shelve(docs, ["doc_id", "text"], NEW)
    numbered = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    scored = _weighed(numbered, gains, seed)
    drawn = scored.join(ranked(scored, percent, min_words), "_row").drop("doc_id", "n_words")
    return back(numbered.join(drawn, "_row"))
