"""Subword ids of whole texts, each distinct word encoded once per worker.

For tokenizers that drop white space and never join text across it (``word_bpe_49k.json`` is one), the ids of a
text are those of its white-space separated words in order. So a batch is cut into words on bytes, only words that
the worker has not met yet go through the tokenizer, and the ids of the batch are gathered from one flat table.
"""

from __future__ import annotations

import functools
from itertools import repeat

import numpy as np
import pyarrow as pa
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

from .bytetext import LOWER, NOT_SPACE, Texts, per_text, string_column, word_borders

TOKENIZER = "word_bpe_49k.json"
# Distinct words a worker remembers; beyond it words that have not been met again are dropped (results do not depend on it).
CACHE_WORDS = 250_000


# ASCII bytes by kind: 1 letter or digit, 2 other, 3 apostrophe; 0 for white space and bytes beyond ASCII
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[0x27] = 3
_KIND[[0x3C, 0x3E, 0x7C]] = 0  # < > | spell the tokenizer's special tokens, which stay whole


def pieces(t: Texts) -> tuple[pa.StringArray, np.ndarray]:
    """(pieces, pieces before each text and in all).

    Words are also cut between letters or digits of ASCII and Latin-1 and ASCII punctuation, where the tokenizer always
    cuts (after an apostrophe it may not); that leaves far fewer distinct pieces. A-Z are lower-cased, as the tokenizer does, unless
    a special token may be spelled.
    """
    data = t.data
    special = (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    data = data if special.any() else LOWER[data]
    inside = NOT_SPACE[data]
    kind = _KIND[data]
    # the letters of Latin-1 are 0xC3 and one more byte, but for the signs of multiplication and division
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    a, b = kind[:-1], kind[1:]
    cuts = np.flatnonzero((a == 1) & (b >= 2) | (a == 2) & (b == 1)) + 1
    start, end, before = word_borders(inside, t, cuts)
    return string_column(data[inside], end - start), before


class WordEncoder:
    def __init__(self, name: str = TOKENIZER, cache_words: int = CACHE_WORDS):
        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.cache_words = cache_words
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 15, np.int64)
        self.lengths = np.zeros(1 << 15, np.int64)
        self.again = np.zeros(1 << 15, bool)  # met again since it was learned, or since the last drop
        self.used = 0

    def drop(self) -> None:
        """Forget the words that have not been met again, or all if few would go."""
        kept = np.flatnonzero(self.again[: len(self.rows)])
        if len(kept) > self.cache_words * 3 // 4:
            return self.forget()
        words, lengths = [*self.rows], self.lengths[kept]  # in order of their rows
        ends = np.cumsum(lengths)
        ids = self.flat[np.repeat(self.starts[kept] - (ends - lengths), lengths) + np.arange(lengths.sum())]
        self.rows = {words[row]: i for i, row in enumerate(kept.tolist())}
        self.flat[: len(ids)], self.used = ids, len(ids)
        self.starts[: len(kept)], self.lengths[: len(kept)] = ends - lengths, lengths
        self.again[:] = False

    def ids_of(self, part: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, number of ids of each piece).

        Pieces are encoded as one text; each ends with an id that ends a word, so if there are as many such ids as
        pieces, they tell where the pieces end. Otherwise some piece has several words, and each is encoded alone.
        """
        ids = np.asarray(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == len(part):
            return ids, np.diff(ends, prepend=0)
        if len(part) > 16:
            halves = [self.ids_of(part[: len(part) // 2]), self.ids_of(part[len(part) // 2 :])]
            return tuple(np.concatenate(x) for x in zip(*halves, strict=True))
        each = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in part]
        return np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each], np.int64)

    def learn(self, words: list[str]) -> None:
        plain = [w for w in words if w.isalpha()]
        rest = [w for w in words if not w.isalpha()]
        for group, size in ((plain, 512), (rest, 16)):
            for a in range(0, len(group), size):
                part = group[a : a + size]
                ids, lengths = self.ids_of(part)
                row = len(self.rows)
                while self.used + len(ids) > len(self.flat):
                    self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
                while row + len(part) > len(self.starts):
                    self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
                    self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
                    self.again = np.concatenate([self.again, np.zeros_like(self.again)])
                self.flat[self.used : self.used + len(ids)] = ids
                self.starts[row : row + len(part)] = self.used + np.cumsum(lengths) - lengths
                self.lengths[row : row + len(part)] = lengths
                self.rows.update(zip(part, range(row, row + len(part)), strict=True))
                self.used += len(ids)

    def table_rows(self, words: pa.StringArray) -> np.ndarray:
        """Row in the flat table of each word."""
        if not len(words):
            return np.zeros(0, np.int64)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.rows) > self.cache_words:
            self.drop()
        found = np.fromiter(map(self.rows.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(found < 0)
        self.again[found[found >= 0]] = True
        if len(new):
            words = [distinct[i] for i in new]
            self.learn(words)
            found[new] = [*map(self.rows.get, words)]
        return found[coded.indices.to_numpy()]

    def encode(self, t: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(all ids end to end, number of ids of each text)."""
        words, before = pieces(t)
        rows = self.table_rows(words)
        lengths = self.lengths[rows]
        places = np.repeat(self.starts[rows] - (np.cumsum(lengths) - lengths), lengths)
        places += np.arange(len(places))
        return self.flat[places], per_text(lengths, before)

    def count(self, t: Texts) -> np.ndarray:
        """Number of ids of each text."""
        words, before = pieces(t)
        rows = self.table_rows(words)  # may replace the tables
        return per_text(self.lengths[rows], before)


@functools.cache
def encoder(name: str = TOKENIZER) -> WordEncoder:
    """The worker's encoder; it lives as long as the Python worker does."""
    return WordEncoder(name)
