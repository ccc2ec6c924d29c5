"""Scores of a whole batch of texts at once: all characters, then all words, as one array with the bounds
of the texts in it, so that a score is a few array operations whatever the number of texts.

The scores are those of the rules in ``scores`` by their names; a cascade takes them from one pass
instead of one scan of every text per rule."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column

from .expr import SPACE_CLASS, deferred

ALNUM, DIGIT, WHITE, BRACKET, SPACE, ALPHA = (1 << i for i in range(6))
# white space at the end of a line; Python's own set for split() is that of SPACE_CLASS
_SPACES = "".join(re.findall(f"[{SPACE_CLASS}]", "".join(map(chr, range(0x3001)))))


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The classes of each code point."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for bit, pattern, where in ((ALNUM, r"[a-zA-Z0-9\n?!,.]", every[:128]), (WHITE, r"[\t\n\r\x08 ]", every[:128]), (BRACKET, r"[{}⟨⟩\[\]()]", every[:0x3000]), (SPACE, f"[{SPACE_CLASS}]", every[:0x3001]), (DIGIT, r"\p{Nd}+", every), (ALPHA, r"\p{Alphabetic}+", every)):
        out[np.frombuffer("".join(regex.findall(pattern, where)).encode("utf-32-le"), np.uint32)] |= bit
    return out


class Batch:
    """Texts of a batch side by side."""

    def __init__(self, texts: Sequence[str]):
        self.texts = texts
        self.n_chars = np.array(list(map(len, texts)), np.int64)
        self.end = np.cumsum(self.n_chars)
        self.points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.kinds = _classes()[self.points]
        self._lines: list[list[str]] | None = None

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.end] - total[self.end - self.n_chars]

    def share_of(self, bit: int) -> np.ndarray:
        return np.where(self.n_chars == 0, 1.0, self.per_text(self.kinds & bit > 0) / np.maximum(self.n_chars, 1))

    @property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and length of each word, and the text it is in."""
        if not hasattr(self, "_words"):
            seen = np.concatenate([[False], self.kinds & SPACE == 0, [False]])
            cut = np.zeros(len(seen), bool)  # a text begins here
            cut[self.end[:-1][self.end[:-1] < len(self.points)] + 1] = True
            begin = np.nonzero(seen[1:] & (~seen[:-1] | cut[1:]))[0]
            stop = np.nonzero(seen[:-1] & (~seen[1:] | cut[1:]))[0]
            self._words = begin, stop - begin, np.searchsorted(self.end, begin, "right")
        return self._words

    @property
    def lines(self) -> list[list[str]]:
        """Lines that are not blank."""
        if self._lines is None:
            self._lines = [[x for x in t.split("\n") if x.strip()] for t in self.texts]
        return self._lines


def _ratio(part, whole) -> np.ndarray:
    part, whole = np.asarray(part, float), np.asarray(whole, float)
    return np.divide(part, whole, out=np.full(len(whole), np.nan), where=whole > 0)


def _words_total(b: Batch) -> np.ndarray:
    return np.bincount(b.words[2], minlength=len(b.texts))


def _symbols(b: Batch, marks: Sequence[str]) -> np.ndarray:
    begin, length, of = b.words
    first = np.array(sorted({ord(m[0]) for m in marks} | {ord("#")}), np.uint32)
    found = np.zeros(len(b.texts), np.int64)
    known = {m for m in marks if " " not in m}
    for i in np.nonzero(np.isin(b.points[begin], first))[0].tolist():
        w = b.points[begin[i] : begin[i] + length[i]].tobytes().decode("utf-32-le", "surrogatepass")
        if w in known or (w[0] == "#" and len(w) % 2 and set(w[::2]) == {"#"} and "#" not in w[1::2]):
            found[of[i]] += 1
    return _ratio(found, _words_total(b))


def _distinct(parts: list[list[str]], characters: bool) -> np.ndarray:
    size = (lambda xs: sum(map(len, xs))) if characters else len
    return _ratio([size(set(p)) for p in parts], [size(p) for p in parts])


def _endings(b: Batch, marks: tuple[str, ...], lower: bool) -> tuple[list[int], list[int]]:
    ends = [sum(x.rstrip(_SPACES).endswith(marks) for x in ([y.lower() for y in ls] if lower else ls)) for ls in b.lines]
    return ends, [len(ls) for ls in b.lines]


def _boilerplate(b: Batch, phrases: Sequence[str]) -> np.ndarray:
    out = np.zeros(len(b.texts))
    for i, t in enumerate(b.texts):
        low = t.lower()
        if "lorem ipsum" in low:
            out[i] = 1.0
        elif any(p in low for p in phrases):
            parts = low.split("\n\n")
            out[i] = sum(any(p in x for p in phrases) for x in parts) / len(parts)
    return out


def _common(b: Batch, words: Sequence[str], most: int) -> np.ndarray:
    begin, length, of = b.words
    found = np.zeros(len(b.texts), np.int64)
    for w in words:
        at = np.nonzero((length == len(w)) & (b.points[begin] == ord(w[0])))[0]
        for j, c in enumerate(w[1:], 1):
            at = at[b.points[begin[at] + j] == ord(c)]
        found += np.bincount(of[at], minlength=len(b.texts))
    return np.minimum(found, most).astype(float)


def _letters(b: Batch) -> np.ndarray:
    begin, length, of = b.words
    total = np.concatenate([[0], np.cumsum(b.kinds & ALPHA > 0)])
    some = total[begin + length] > total[begin]
    return _ratio(np.bincount(of, some, len(b.texts)), _words_total(b))


def _longest(b: Batch) -> np.ndarray:
    out = np.full(len(b.texts), np.nan)
    begin, length, of = b.words
    first = np.nonzero(np.r_[True, of[1:] != of[:-1]])[0] if len(of) else np.zeros(0, np.int64)
    if len(first):
        out[of[first]] = np.maximum.reduceat(length, first)
    return out


def _urls(b: Batch, pattern: str) -> np.ndarray:
    find = re.compile(pattern).finditer
    return np.array([1.0 if not t else sum(len(m[0]) for m in find(t)) / len(t) if "http" in t else 0.0 for t in b.texts])


def _bullets(b: Batch, marks: str) -> np.ndarray:
    pattern = re.compile(f"(?<![^\\n])[^\\S\\n]*[{marks}]")
    return _ratio([len(pattern.findall(t)) if not t.isascii() else 0 for t in b.texts], [len(ls) for ls in b.lines])


def _paragraphs(b: Batch) -> list[list[str]]:
    return [t.split("\n\n") for t in b.texts]


@lru_cache(maxsize=1)
def _scorers() -> dict[str, Callable[[Batch], np.ndarray]]:
    from . import scores as S

    def punctuation(b: Batch) -> np.ndarray:
        ends, total = _endings(b, tuple(".?!\"'"), False)
        return _ratio(np.subtract(total, ends), total)

    return {
        "non_alphanumeric": lambda b: np.where(b.n_chars == 0, 1.0, 1 - b.share_of(ALNUM)), "symbols_to_words": lambda b: _symbols(b, S.ELLIPSES), "numbers": lambda b: b.share_of(DIGIT), "urls": lambda b: _urls(b, S.URL),
        "white_space": lambda b: b.share_of(WHITE), "parentheses": lambda b: b.share_of(BRACKET), "boilerplate": lambda b: _boilerplate(b, S.POLICY), "repeated_lines": lambda b: _distinct(b.lines, False),
        "repeated_paragraphs": lambda b: _distinct(_paragraphs(b), False), "repeated_lines_by_char": lambda b: _distinct(b.lines, True), "repeated_paragraphs_by_char": lambda b: _distinct(_paragraphs(b), True),
        "word_count": lambda b: _words_total(b).astype(float), "punctuation": punctuation, "words_without_alphabets": _letters, "common_english_words": lambda b: _common(b, S.COMMON_WORDS, 2),
        "mean_word_length": lambda b: _ratio(b.per_text(b.kinds & SPACE == 0), _words_total(b)), "long_word": _longest, "ellipsis": lambda b: _ratio(*_endings(b, S.ELLIPSES, True)), "bullets": lambda b: _bullets(b, S.BULLETS),
    }


def supported(names: Sequence[str]) -> bool:
    return set(names) <= set(_scorers())


def heuristics(names: Sequence[str]) -> Callable[[Column], Column]:
    """The scores of the named rules as one struct; null for a null text."""

    def run(texts: pd.Series) -> pd.DataFrame:
        real = texts.notna().to_numpy()
        b, score = Batch(texts[real].tolist()), _scorers()
        out = np.full((len(texts), len(names)), np.nan)
        if real.any():
            out[real] = np.stack([score[n](b) for n in names], 1)
        return pd.DataFrame(out, columns=list(names)).astype("Float64")

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return deferred(run, ", ".join(f"{n} double" for n in names))


# --- n-grams of words ------------------------------------------------------------------------------


class Grams:
    """Word n-grams of many texts as hashes, for several n."""

    def __init__(self, texts: Sequence[str]):
        self.texts, self.words = texts, [t.split() for t in texts]
        self.sizes = np.array(list(map(len, self.words)), np.int64)
        ids: dict[str, int] = {}
        flat = [ids.setdefault(w, len(ids)) for ws in self.words for w in ws]
        self.x = (np.array(flat, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        self.lengths = np.fromiter((len(w) for ws in self.words for w in ws), np.int64, len(flat))
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.of = np.repeat(np.arange(len(texts)), self.sizes)
        self.hashes: dict[int, np.ndarray] = {1: self.x}
        self.found: dict[int, tuple] = {}

    def hash(self, n: int) -> np.ndarray:
        """Of the n-gram that begins at each word; those that reach into the next text mean nothing."""
        if n not in self.hashes:
            h = self.hash(n - 1)[:-1]
            self.hashes[n] = (h ^ (h >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F) + self.x[n - 1 :]
        return self.hashes[n]

    def groups(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, first place, count) of the n-grams that are repeated in their text.  An n-gram can only
        be repeated where its first n - 1 words are."""
        if n not in self.found:
            shorter = max((m for m in self.found if m < n), default=None)
            at = np.arange(len(self.x)) if shorter is None else self.found[shorter][0]
            at = at[at + n <= self.begin[self.of[at]] + self.sizes[self.of[at]]] if len(at) else at
            h = self.hash(n)[at] if len(at) else np.zeros(0, np.uint64)
            order = np.lexsort((at, h, self.of[at]))
            at, h = at[order], h[order]
            new = np.r_[True, (h[1:] != h[:-1]) | (self.of[at[1:]] != self.of[at[:-1]])] if len(at) else np.zeros(0, bool)
            group = np.cumsum(new) - 1
            count = np.bincount(group)[group] if len(at) else np.zeros(0, np.int64)
            first = at[np.nonzero(new)[0]][group] if len(at) else at
            many = count > 1
            self.found[n] = at[many], first[many], count[many]
        return self.found[n]

    def top_shares(self, n: int) -> np.ndarray:
        """Share of characters that go with the most frequent n-gram, the first of equals; 1 for fewer words."""
        at, first, count = self.groups(n)
        out, top = np.ones(len(self.texts)), self.begin.copy()
        order = np.lexsort((first, -count, self.of[at]))
        of, lead = self.of[at[order]], first[order]
        head = np.nonzero(np.r_[True, of[1:] != of[:-1]])[0] if len(of) else np.zeros(0, np.int64)
        top[of[head]] = lead[head]
        for i in np.nonzero(self.sizes >= n)[0].tolist():
            a = int(top[i] - self.begin[i])
            most = " ".join(self.words[i][a : a + n])
            out[i] = self.texts[i].count(most) * len(most) / len(self.texts[i])
        return out

    def duplicate_shares(self, n: int) -> np.ndarray:
        """Share of characters inside n-grams that came before; overlaps count once; 1 for fewer words."""
        at, first, _ = self.groups(n)
        again = np.sort(at[at != first])
        out = np.where(self.sizes < n, 1.0, 0.0)
        if not len(again):
            return out
        of = self.of[again]
        gap = np.diff(again, prepend=again[0] - n)
        gap[np.r_[True, of[1:] != of[:-1]]] = n
        covered = np.maximum(0, n - gap)  # leading words that are counted already
        ends = np.concatenate([[0], np.cumsum(self.lengths)])
        chars = ends[again + n] - ends[again + covered] + np.minimum(n - covered, n - 1)
        total = np.bincount(of, chars, len(self.texts))
        some = total > 0
        out[some] = total[some] / np.array([len(self.texts[i]) for i in np.nonzero(some)[0]])
        return out


def gram_shares(tops: Sequence[int] = (2, 3, 4), duplicates: Sequence[int] = (5, 6, 7, 8, 9, 10)) -> Callable[[Column], Column]:
    """n-gram shares as one struct (top_2 ..., dup_5 ...); null for a null text."""
    names = [f"top_{n}" for n in tops] + [f"dup_{n}" for n in duplicates]

    def run(texts: pd.Series) -> pd.DataFrame:
        real = texts.notna().to_numpy()
        g = Grams(texts[real].tolist())
        out = np.full((len(texts), len(names)), np.nan)
        if real.any():
            out[real] = np.stack([g.top_shares(n) for n in sorted(tops)] + [g.duplicate_shares(n) for n in sorted(duplicates)], 1)
        return pd.DataFrame(out, columns=[f"top_{n}" for n in sorted(tops)] + [f"dup_{n}" for n in sorted(duplicates)]).astype("Float64")[names]

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return deferred(run, ", ".join(f"{x} double" for x in names))


def gram_share(kind: str, n: int) -> Callable[[Column], Column]:
    """One of these shares."""

    def run(texts: pd.Series) -> pd.Series:
        real = texts.notna().to_numpy()
        g = Grams(texts[real].tolist())
        out = np.full(len(texts), np.nan)
        if real.any():
            out[real] = g.top_shares(n) if kind == "top" else g.duplicate_shares(n)
        return pd.Series(out).astype("Float64")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return deferred(run, "double")
