"""N-grams counted in Arrow batches, so that what leaves a task are partial counts.

Words are numbers here, and an n-gram is the number of its first n - 1 words and that of its last.
Equal n-grams come together by sorting numbers; only distinct ones become text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# What is counted at once, a longer document by itself. An n-gram and its document
# then fit in 63 bits.
WORDS = 1 << 22
ROWS = 1 << 18


def frequencies(keys: np.ndarray, n_docs: int) -> tuple[np.ndarray, ...]:
    """Distinct n-grams, the documents that have each, and its occurrences, from one key for every
    occurrence: n-gram times ``n_docs`` plus document."""
    keys.sort()
    grams = keys // n_docs
    first = np.flatnonzero(np.diff(grams, prepend=-1))
    df = np.add.reduceat(np.diff(keys, prepend=-1) > 0, first, dtype="int64")
    return grams[first], df, np.diff(first, append=len(grams))


def term_freq(docs: pa.Array, ngram_max: int) -> Iterator[pa.RecordBatch]:
    """``(term, df, total)`` of documents that are lists of words; the same term may come again."""
    sizes = pc.list_value_length(docs).to_numpy(zero_copy_only=False)
    if len(docs) > 1 and (len(docs) > ROWS or sizes.sum() > WORDS):
        half = len(docs) // 2
        yield from term_freq(docs.slice(0, half), ngram_max)
        yield from term_freq(docs.slice(half), ngram_max)
        return
    encoded = docs.flatten().dictionary_encode()
    words, at = encoded.dictionary, encoded.indices.to_numpy()
    doc = np.repeat(np.arange(len(docs), dtype="int32"), sizes)
    starts = None  # texts of the first n - 1 words

    def texts(grams: np.ndarray) -> pa.Array:
        last = words.take(pa.array(grams % len(words)))
        if starts is None:
            return last
        return pc.binary_join_element_wise(starts.take(pa.array(grams // len(words))), last, " ")

    grams = at.astype("int64")
    for n in range(1, min(ngram_max, len(at)) + 1):
        if n == 2:
            starts = words
        elif n > 2:  # numbered anew, as they would grow with every word
            kinds, grams = np.unique(grams, return_inverse=True)
            starts = texts(kinds)
        if n > 1:
            grams = grams[:-1] * len(words) + at[n - 1:]
        inside = doc[:len(grams)] == doc[n - 1:]
        if inside.any():
            keys = (grams * len(docs) + doc[:len(grams)])[inside]
            found, df, total = frequencies(keys, len(docs))
            yield pa.RecordBatch.from_arrays(
                [texts(found), pa.array(df), pa.array(total)], ["term", "df", "total"])
