"""Language model scores from Brown's class-based bigrams.

Units are the most frequent words, each by itself, and groups of all other words by their ending.
Exchange clustering moves units between classes as long as that raises the likelihood of the
training text. A text's probability is the product of class transitions, smoothed by the classes'
own frequencies, and of the words' shares in their classes.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.text import stored

CLASSES = 48
CLUSTERED = 2_000  # words that are units by themselves
GROUPS = 500  # units for the others, by their last three bytes
LISTED = 65_536  # words whose counts are broadcast, about 3 MB; those of others are joined
SWEEPS = 12
PRIOR = 0.1  # added to every word's count
PULL = 1.0  # weight of a class's own frequency in its transitions
COUNTED = 300_000  # distinct words a task counts before it passes them on


def held_out(doc_id: Column) -> Column:
    """One in ten by the id's text; a null id is training text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all rows of ``text``, counted in the tasks before they are shuffled."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([w.decode() for w in counts], pa.string()),
            pa.array(list(counts.values()), pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(_words(text))
                if len(counts) > COUNTED:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    return texts.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


def group_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % GROUPS


class Units:
    """Numbers of units and of listed words. Units: clustered words, then groups, then the end."""

    def __init__(self, listed: list[tuple[str, int]], clustered: int):
        self.index = {w.encode(): i for i, (w, _) in enumerate(listed)}
        self.counts = np.array([n for _, n in listed], "float64")
        self.clustered = min(clustered, len(listed))
        self.end = self.clustered + GROUPS
        self.unit = np.array([i if i < self.clustered else self.clustered + group_of(w)
                              for w, i in self.index.items()] + [0], "int64")

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Listed number (or -1) and unit of each word, and the places of words not listed."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), "int64", len(words))
        units = self.unit[at]
        other = np.flatnonzero(at < 0)
        if len(other):
            units[other] = [self.clustered + group_of(words[i]) for i in other.tolist()]
        return at, units, other


def unit_bigrams(texts: DataFrame, units) -> DataFrame:
    """``x``, ``y``, ``n`` of neighbouring units, each text between two ends. A task adds up a table
    of all pairs, of which there are ``(CLUSTERED + GROUPS + 1) ** 2`` at most."""
    schema = pa.schema([("x", pa.int32()), ("y", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = units.value
        size = u.end + 1
        table = np.zeros(size * size, "int32")
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seq = np.concatenate(([u.end], u.of(_words(text))[1], [u.end]))
                pairs, n = np.unique(seq[:-1] * size + seq[1:], return_counts=True)
                table[pairs] += n.astype("int32")
        met = np.flatnonzero(table)
        for k in range(0, len(met), 1 << 18):
            part = met[k:k + (1 << 18)]
            yield pa.RecordBatch.from_arrays([
                pa.array((part // size).astype("int32")), pa.array((part % size).astype("int32")),
                pa.array(table[part].astype("int64"))], schema=schema)

    return texts.select("text").mapInArrow(count, "x int, y int, n long").groupBy("x", "y").agg(
        F.sum("n").alias("n"))


def _likelihood(n: np.ndarray) -> np.ndarray:
    """n log n, 0 at 0."""
    return n * np.log(np.maximum(n, 1))


def exchange(table: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Class of each unit; the last unit, the end, has the last class to itself. Units are taken one
    by one, most frequent first, and put where the likelihood of class bigrams is highest; sweeps
    end when no unit moves."""
    size = len(table)
    k = classes + 1
    left, right = table.sum(axis=1), table.sum(axis=0)
    order = np.argsort(-(left[:-1] + right[:-1]), kind="stable")
    cls = np.empty(size, "int64")
    cls[order] = np.arange(size - 1) % classes
    cls[-1] = classes
    one = np.zeros((size, k))
    one[np.arange(size), cls] = 1
    pair = one.T @ table @ one
    out, into = pair.sum(axis=1), pair.sum(axis=0)
    columns = np.ascontiguousarray(table.T)
    for _ in range(sweeps):
        moved = 0
        for v in order.tolist():
            own = table[v, v]
            a = cls[v]
            to = np.bincount(cls, table[v], k)  # from v into each class
            by = np.bincount(cls, columns[v], k)  # from each class into v
            to[a] -= own
            by[a] -= own
            # take v out
            pair[a] -= to
            pair[:, a] -= by
            pair[a, a] -= own
            out[a] -= left[v]
            into[a] -= right[v]
            # gain of putting v into each class c: row c and column c of the table change
            base = _likelihood(pair)
            rows = (_likelihood(pair + to) - base).sum(axis=1)
            cols = (_likelihood(pair + by[:, None]) - base).sum(axis=0)
            corner = np.diag(pair)
            fix = (_likelihood(corner + to + by + own) + _likelihood(corner)
                   - _likelihood(corner + to) - _likelihood(corner + by))
            gain = rows + cols + fix - (
                _likelihood(out + left[v]) - _likelihood(out)
                + _likelihood(into + right[v]) - _likelihood(into))
            best = int(np.argmax(gain[:classes]))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            moved += best != a
            cls[v] = best
            pair[best] += to
            pair[:, best] += by
            pair[best, best] += own
            out[best] += left[v]
            into[best] += right[v]
        if not moved:
            break
    return cls


def unit_classes(bigrams: DataFrame, size: int, classes: int, sweeps: int) -> DataFrame:
    """``unit``, ``cls`` and ``n`` (its tokens). One task holds the table of unit pairs, whose size is
    set by the parameters and not by the corpus."""
    schema = pa.schema([("unit", pa.int32()), ("cls", pa.int32()), ("n", pa.int64())])

    def cluster(rows: pa.Table) -> pa.Table:
        table = np.zeros((size, size))
        table[rows.column("x").to_numpy(), rows.column("y").to_numpy()] = rows.column("n")
        cls = exchange(table, classes, sweeps)
        return pa.Table.from_arrays([
            pa.array(np.arange(size, dtype="int32")), pa.array(cls.astype("int32")),
            pa.array(table.sum(axis=0).astype("int64"))], schema=schema)

    return bigrams.groupBy(F.lit(0).alias("_all")).applyInArrow(
        cluster, "unit int, cls int, n long")


class Model:
    """What tasks need to score a text, all of it of bounded size."""

    def __init__(self, units: Units, cls: np.ndarray, tokens: np.ndarray, types: np.ndarray,
                 pairs: np.ndarray, ends: int):
        self.units, self.cls, self.ends = units, cls, ends
        k = pairs.shape[0]
        total = np.bincount(cls, tokens, k)
        free = np.bincount(cls, np.r_[np.zeros(units.clustered), np.ones(GROUPS), 0], k)
        room = total + PRIOR * (np.bincount(cls, types, k) + free)
        self.room = np.log10(np.where(room > 0, room, 1))
        own = (total + 1) / (total.sum() + k)
        self.step = np.log10((pairs + PULL * own) / (pairs.sum(axis=1, keepdims=True) + PULL))
        self.log_count = np.log10(np.r_[units.counts, 0] + PRIOR)

    def score(self, text: str | None) -> tuple[int, int, float, float, list[bytes]]:
        """Tokens; known ones among the listed words and the end; the sum of log10(count + prior)
        over these; all that the score has besides the words' counts; the words not listed."""
        words = _words(text)
        at, units, other = self.units.of(words)
        cls, end = self.cls[units], self.cls[self.units.end]
        seq = np.concatenate(([end], cls, [end]))
        counts = self.log_count[at].sum() - len(other) * self.log_count[-1]
        return (len(words) + 1, len(words) - len(other) + (self.ends > 0), float(counts),
                float(self.step[seq[:-1], seq[1:]].sum() - self.room[cls].sum()),
                [words[i] for i in other.tolist()])


def class_scores(
    docs: DataFrame, *, classes: int = CLASSES, clustered: int = CLUSTERED, listed: int = LISTED,
    sweeps: int = SWEEPS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score``.

    The model learns from the rows that are not held out. Needs ``doc_id`` and ``text``; other
    columns are not used. A null or empty text is its end alone. Repeated rows are learned from as
    often as they come and scored each; a null id is training text. Without training text every
    word is unknown and classes are arbitrary. No rows in, no rows out.
    """
    spark = docs.sparkSession
    training = docs.filter(~held_out(F.col("doc_id"))).select("text")
    counts = stored(word_counts(training), "counts")
    n_words, n_types = counts.agg(F.sum("n"), F.count("*")).first()
    n_ends = training.count()
    n_all, n_types = (n_words or 0) + n_ends, n_types + (n_ends > 0)

    top = counts.orderBy(F.desc("n"), "word").limit(listed).collect()
    units = Units([(r["word"], r["n"]) for r in top], clustered)
    sent = spark.sparkContext.broadcast(units)
    size = units.end + 1
    bigrams = stored(unit_bigrams(training, sent), "bigrams")
    found = unit_classes(bigrams, size, classes, sweeps).collect()
    cls = np.arange(size) % classes
    cls[-1] = classes
    tokens = np.zeros(size)
    for r in found:
        cls[r["unit"]], tokens[r["unit"]] = r["cls"], r["n"]

    # class bigrams, and word types per unit
    named = spark.createDataFrame([(i, int(c)) for i, c in enumerate(cls)], "unit int, c int")
    pair_rows = bigrams.join(F.broadcast(named.toDF("x", "cx")), "x").join(
        F.broadcast(named.toDF("y", "cy")), "y").groupBy("cx", "cy").agg(F.sum("n")).collect()
    pairs = np.zeros((classes + 1, classes + 1))
    for x, y, n in pair_rows:
        pairs[x, y] = n
    ending = F.substring(F.col("word").cast("binary"), -3, 3)
    group_rows = counts.groupBy((F.crc32(ending) % GROUPS).cast("int").alias("g")).count().collect()
    types = np.zeros(size)
    for g, n in group_rows:
        types[units.clustered + g] = n
    for w, i in units.index.items():
        if i < units.clustered:
            types[i] += 1
            types[units.clustered + group_of(w)] -= 1
    types[-1] = 1
    model = spark.sparkContext.broadcast(Model(units, cls, tokens, types, pairs, n_ends))

    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
        ("known", pa.int64()), ("counts", pa.float64()), ("rest", pa.float64()),
        ("others", pa.list_(pa.string()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.value.score(t) for t in batch.column(2).to_pylist()]
            n, known, logs, rest, others = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                pa.array(known, pa.int64()), pa.array(logs, pa.float64()),
                pa.array(rest, pa.float64()),
                pa.array([[w.decode() for w in o] for o in others], pa.list_(pa.string()))],
                schema=schema)

    scored = stored(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
                    .mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, known long, "
                                       "counts double, rest double, others array<string>")
                    .withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("_row", F.explode("others").alias("word")).join(counts, "word", "left")
    sums = rare.groupBy("_row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(PRIOR))).alias("_logs"),
        F.count("n").alias("_known"))
    logs = F.col("counts") + F.coalesce("_logs", F.lit(0.0)) + F.lit(float(np.log10(n_ends + PRIOR)))
    room = float(np.log10(n_all + PRIOR * (n_types + 1)))
    return scored.drop("others").join(sums, "_row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * room).alias("base_score"),
        (logs - F.lit(float(np.log10(n_ends + PRIOR))) + F.col("rest")).alias("score"))
