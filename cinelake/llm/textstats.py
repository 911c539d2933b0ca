"""Counts of whole texts that the quality operators share, for many texts at once."""

from __future__ import annotations

import re
import zlib

import numpy as np

from cinelake.llm.pretokens import white_words
from cinelake.llm.tables import worker_cache

#: The symbols that count as noise.
SYMBOLS = "#*$%&|<>"

#: Words that insult; a parameter of the operators.
INSULTS = ("clown", "cretin", "disgusting", "fool", "freak", "garbage", "idiot", "idiotic", "imbecile", "jerk",
           "loser", "moron", "moronic", "pathetic", "scum", "scumbag", "stupid", "trash", "vermin", "worthless")

_ENDS = ".,;:!?\"'()[]" + SYMBOLS  # marks that do not belong to a word
WORDS = re.compile("[^\x20\x09-\x0d]+")
WINDOW = 5
WORDS_KEPT = 600_000

#: Names of the counts, all whole numbers.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_echo",
          "n_distinct", "n_noisy", "n_short", "n_marks", "n_insults", "n_insult_kinds")

_UPPER, _NOISY, _SHORT, _LENGTH, _RUDE = 1, 2, 4, 3, 40  # flag bits, then bit places of length and insult


class _Words:
    """Attributes and hashed places of words, made at their first use and kept
    between batches; beyond WORDS_KEPT words a worker begins anew."""

    def __init__(self, insults: tuple[str, ...]):
        self.ranks = {w: k + 1 for k, w in enumerate(insults)}
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.attributes, self.slots = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.rows) > WORDS_KEPT:
            self._clear()
        rows, ranks = self.rows, self.ranks
        fresh = [w for w in words if w not in rows]
        if fresh:
            first = len(rows)
            while first + len(fresh) > len(self.slots):
                self.attributes = np.concatenate([self.attributes, np.zeros_like(self.attributes)])
                self.slots = np.concatenate([self.slots, np.zeros_like(self.slots)])
            bare = [w.strip(_ENDS).lower() for w in fresh]
            place = slice(first, first + len(fresh))
            self.slots[place] = [zlib.crc32(w.encode()) for w in bare]
            size = np.fromiter(map(len, fresh), np.int64, len(fresh))
            upper = np.fromiter(map(str.isupper, fresh), bool, len(fresh)) & (size > 3)
            noisy = np.fromiter((w[-1] in SYMBOLS for w in fresh), bool, len(fresh))
            rude = np.array([ranks.get(w, 0) for w in bare], np.int64)
            self.attributes[place] = (upper * _UPPER | noisy * _NOISY | (size < 4) * _SHORT
                                      | np.minimum(size, (1 << 36) - 1) << _LENGTH | rude << _RUDE)
            rows.update(zip(fresh, range(first, first + len(fresh))))
        at = np.fromiter(map(rows.__getitem__, words), np.int64, len(words))
        return self.attributes[at], self.slots[at]


def slot(word: str) -> int:
    """Hashed place of a word, lower-cased and without marks at its ends."""
    return zlib.crc32(word.strip(_ENDS).lower().encode())


class Texts:
    """A batch of texts (null reads as empty) and their words, with the
    attributes and hashed place of each distinct word."""

    def __init__(self, batch: list[str | None], insults: tuple[str, ...] = INSULTS):
        self.texts, self.insults = [t or "" for t in batch], insults
        self.words, self.places, self.firsts = white_words(self.texts)
        self.sizes = np.diff(self.firsts)
        self.owner = np.repeat(np.arange(len(self.texts)), self.sizes)
        self.attributes, self.slots = worker_cache(("words", insults), lambda: _Words(insults)).of(self.words)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums by text of a value for each word."""
        return np.bincount(self.owner, values, len(self.texts)).astype(np.int64)


def repeated(words: list, window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more in the text."""
    windows = list(zip(*(words[k:] for k in range(window))))
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered, end = 0, 0
    for k, w in enumerate(windows):
        if seen[w] > 1:
            covered += k + window - max(k, end)
            end = k + window
    return covered


def _repeats(texts: Texts) -> np.ndarray:
    """``repeated`` of every text. Windows with equal hashes are compared word
    by word; a text in which two differ is counted window by window."""
    total = len(texts.places)
    out, n = np.zeros(len(texts.texts), np.int64), total - WINDOW + 1
    if n <= 0:
        return out
    key = texts.owner[:n].astype(np.uint64)
    for k in range(WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + texts.places[k:k + n].astype(np.uint64)
        key ^= key >> np.uint64(29)
    inside = np.flatnonzero(texts.owner[:n] == texts.owner[WINDOW - 1:])
    order = inside[np.argsort(key[inside])]
    met = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    one, two = order[:-1][met], order[1:][met]
    equal = texts.owner[one] == texts.owner[two]
    for k in range(WINDOW):
        equal &= texts.places[one + k] == texts.places[two + k]
    starts = _distinct(np.concatenate([one[equal], two[equal]]))
    steps = np.zeros(total + 1, np.int64)
    steps[starts] += 1
    steps[starts + WINDOW] -= 1
    out += texts.sums(np.cumsum(steps)[:total] > 0)
    for k in _distinct(texts.owner[np.concatenate([one[~equal], two[~equal]])]):
        out[k] = repeated(texts.places[texts.firsts[k]:texts.firsts[k + 1]].tolist())
    return out


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def counts(texts: Texts) -> np.ndarray:
    """Rows of ``COUNTS``; a text without words has zeros only."""
    insults, own = texts.insults, texts.attributes[texts.places]
    rude, n = own >> _RUDE, len(texts.texts)
    lines, dups, symbols, marks = [], [], [], []
    for t in texts.texts:
        rows = [row for row in t.split("\n") if WORDS.search(row)]
        lines.append(len(rows))
        dups.append(len(rows) - len(set(rows)))
        symbols.append(sum(map(t.count, SYMBOLS)) if rows else 0)
        marks.append(t.count("!") + t.count("?") if rows else 0)
    pairs = _distinct(texts.owner * max(1, len(texts.words)) + texts.places) // max(1, len(texts.words))
    echo = np.zeros(len(own), bool)
    echo[1:] = (texts.places[1:] == texts.places[:-1]) & (texts.owner[1:] == texts.owner[:-1])
    hits = np.flatnonzero(rude)
    kinds = np.unique(texts.owner[hits] * (len(insults) + 1) + rude[hits]) // (len(insults) + 1)
    return np.stack([texts.sizes, texts.sums(own >> _LENGTH & (1 << 36) - 1), symbols, lines, dups, _repeats(texts),
                     texts.sums(own & _UPPER > 0), texts.sums(echo), np.bincount(pairs, minlength=n),
                     texts.sums(own & _NOISY > 0), texts.sums(own & _SHORT > 0), marks, texts.sums(rude > 0),
                     np.bincount(kinds, minlength=n)], axis=1).astype(np.int64)
