"""Token ids of a word-wise byte-pair vocabulary, one pre-token at a time.

Pre-tokens are what lies between blanks. Merges never cross a blank, so a text's ids are those of its
pre-tokens in a row, and a pre-token's ids can be looked up instead of worked out. Texts in Latin-1
need lower case only; for others the library normalises, and texts that may hold a special string
are left to the library as a whole.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, groupby, islice
from pathlib import Path

import numpy as np

LATIN = [chr(c) for c in range(256)]
MOST_RECENT = 400_000  # pre-tokens, and pieces, a worker remembers before it starts anew
CHUNK = 1_000_000
SEPARATORS = "\x1c\x1d\x1e\x1f"  # blanks for ``str.split``, but not by Unicode's White_Space
BLANKS = "".join(chr(c) for c in range(sys.maxunicode) if chr(c).isspace()
                 and chr(c) not in SEPARATORS)
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"  # fixed value: part of the vocabulary's pattern


def latin_pattern() -> re.Pattern:
    """The vocabulary's pre-tokens, and single blanks, for lower-cased Latin-1 text."""
    def kind(first: str) -> str:
        return "".join(re.escape(c) for c in LATIN if unicodedata.category(c)[0] == first)

    letters, numbers = kind("L"), kind("N")
    return re.compile(
        f" |{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{BLANKS}{letters}{numbers}]+")


class Numbered(dict):
    """Numbers of strings in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number

    def of(self, strings: Iterable[str], n: int) -> tuple[np.ndarray, list[str]]:
        """The numbers of ``n`` strings, and those strings that were not known."""
        before = len(self)
        numbers = np.fromiter(map(self.__getitem__, strings), "int64", n)
        return numbers, [*islice(reversed(self), len(self) - before)][::-1]


def runs_of(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``pool[start:start + length]`` of each run, one after the other."""
    ends = np.cumsum(lengths)
    places = np.repeat(starts - ends + lengths, lengths)
    places += np.arange(len(places))
    return pool[places]


class Lookup:
    """Ids of strings by their number, as runs of one array. Frequent ones, of which lengths are
    enough, are always there, others as long as this worker remembers."""

    def __init__(self, frequent: dict[str, int]):
        self.frequent = frequent
        self.forget()

    def forget(self) -> None:
        self.known = Numbered(zip(self.frequent, range(len(self.frequent))))
        self.pool = np.array([], "<u4")
        self.starts = np.zeros(len(self.frequent), "int64")
        self.lengths = np.array([*self.frequent.values()], "int64")

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The ids of the strings that were numbered last."""
        starts = len(self.pool) + np.cumsum(lengths) - lengths
        self.pool = np.concatenate((self.pool, ids))
        self.starts = np.concatenate((self.starts, starts))
        self.lengths = np.concatenate((self.lengths, lengths))

    def is_full(self) -> bool:
        return len(self.known) > MOST_RECENT + len(self.frequent)


class Encoder:
    """Ids or numbers of ids of whole texts, as the library gives them without added tokens."""

    def __init__(self, vocabulary: str, frequent_lengths: dict[str, int] | None = None):
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if len(steps) != 2 or steps[0]["type"] != "Split" or steps[1]["type"] != "ByteLevel":
            raise ValueError("a vocabulary that splits by a pattern, then into bytes, is needed")
        self.whole = Tokenizer.from_str(vocabulary)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        # pieces are cut before they come here: what is left to split at are blanks
        steps[0] = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed",
                    "invert": False}
        spec.update(normalizer=None, added_tokens=[])
        self.listed = Tokenizer.from_str(json.dumps(spec))
        vocab, suffix = self.listed.get_vocab(), spec["model"].get("end_of_word_suffix") or ""
        self.id_bytes = np.zeros(max(vocab.values()) + 1, "int64")  # a character is a byte there
        self.id_bytes[[*vocab.values()]] = [len(t.removesuffix(suffix)) for t in vocab]
        self.pattern, self.blanks = latin_pattern(), re.compile(f"[{BLANKS}]+")
        self.pieces = Lookup({" ": 0})
        self.ids_of, self.length_of = Lookup({}), Lookup(frequent_lengths or {})

    def pre_tokens(self, text: str) -> list[str] | None:
        """What lies between blanks, in the vocabulary's case and form; no merge crosses a blank.
        None if the text may hold a special string."""
        if any(s in text for s in self.specials):
            return None
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            text = self.whole.normalizer.normalize_str(text)
        if any(c in text for c in SEPARATORS):
            return self.blanks.split(text.strip(" "))
        return text.split()

    def _pieces(self, tokens: list[str]) -> list[str]:
        """Pre-tokens cut by the vocabulary's pattern, a blank after each."""
        out = []
        for latin, run in groupby(tokens, is_latin):
            if latin:
                out += self.pattern.findall(" ".join([*run, ""]))
                continue
            for token in run:
                cut = self.whole.pre_tokenizer.pre_tokenize_str(token)
                out += [*(token[a:b] for _, (a, b) in cut), " "]
        return out

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces and how many each has. A blank keeps pieces apart, so one call does
        for many. Ids stand for bytes, so the pieces' bytes tell them apart; if these do not add up,
        the library's word numbers do, which take longer."""
        line = " ".join(pieces)
        out = self.listed.encode_batch_fast([line], add_special_tokens=False)
        ids = np.array(out[0].ids, "<u4")
        places, ends = np.cumsum(self.id_bytes[ids]), np.cumsum([len(p.encode()) for p in pieces])
        last = np.searchsorted(places, ends)
        if last[-1] == len(ids) - 1 and (places[last] == ends).all():
            return ids, np.diff(last, prepend=-1)
        out = self.listed.encode(line, add_special_tokens=False)
        words = np.array(out.word_ids, "int64")
        if len(words) == 0 or words[-1] != len(pieces) - 1:
            raise ValueError("the vocabulary leaves a piece without ids")
        return np.array(out.ids, "<u4"), np.bincount(words)

    def _learn(self, table: Lookup, tokens: list[str]) -> None:
        """Ids of pre-tokens, joined from those of their pieces, many of which they share."""
        if self.pieces.is_full():
            self.pieces.forget()
        cut = self._pieces(tokens)
        numbers, fresh = self.pieces.known.of(cut, len(cut))
        for k in range(0, len(fresh), 4096):
            self.pieces.add(*self._encoded(fresh[k:k + 4096]))
        lengths = self.pieces.lengths[numbers]
        ends = np.cumsum(lengths)[numbers == 0]
        ids = runs_of(self.pieces.pool, self.pieces.starts[numbers], lengths)
        table.add(ids, np.diff(ends, prepend=0))

    def _each(self, texts: list[str], table: Lookup) -> Iterator:
        """Texts by chunks: their pre-tokens' numbers, where each text's end, and which of the texts
        are left to the library."""
        for some in _chunks(texts):
            if table.is_full():
                table.forget()
            lists = [self.pre_tokens(t) for t in some]
            ends = np.cumsum([len(x or ()) for x in lists])
            numbers, fresh = table.known.of(chain.from_iterable(filter(None, lists)), ends[-1])
            if fresh:
                self._learn(table, fresh)
            yield numbers, ends, [t if x is None else None for t, x in zip(some, lists, strict=True)]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        table = self.ids_of
        for numbers, ends, left in self._each(texts, table):
            lengths = table.lengths[numbers]
            flat = runs_of(table.pool, table.starts[numbers], lengths).tobytes()
            start = 0
            for text, end in zip(left, _sums(lengths, ends), strict=True):
                yield flat[4 * start:4 * end] if text is None else self._whole(text).tobytes()
                start = end

    def lengths(self, texts: list[str]) -> Iterator[int]:
        table = self.length_of
        for numbers, ends, left in self._each(texts, table):
            start = 0
            for text, end in zip(left, _sums(table.lengths[numbers], ends), strict=True):
                yield end - start if text is None else len(self._whole(text))
                start = end


def _sums(values: np.ndarray, ends: np.ndarray) -> list[int]:
    return np.concatenate(([0], np.cumsum(values)))[ends].tolist()


def is_latin(token: str) -> bool:
    return token.isascii() or max(token) <= LATIN[-1]


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in runs of about ``CHUNK`` characters, so that their pre-tokens fit in memory."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= CHUNK:
            yield some
            some, size = [], 0
    if some:
        yield some


_ENCODERS: dict = {}


def worker_encoder(vocabulary, frequent=None) -> Encoder:
    """This worker's encoder for two broadcasts; tasks that follow in the worker use it again."""
    key = (vocabulary.value[:64], len(vocabulary.value), id(frequent and frequent.value))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary.value, frequent and frequent.value)
    return _ENCODERS[key]


def read_vocabulary(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")
