"""Text quality statistics and a verdict on natural prose (problem 5) by a Gaussian mixture.

The document is taken apart at blank lines.  Each block gets the statistics in ``FEATURES``; they are
standardised, and a mixture of Gaussians, fitted by expectation-maximisation on the blocks of a
bounded sample of labelled documents (``train_docs``, chosen by a hash of the id), gives each block
its component.  Components begin at the inspected examples below, which weigh as ``STRENGTH`` blocks each
throughout, so that none wanders off and any number of blocks will do.  A component is named by the example
it began at, prose, list, table or junk; where the labels of documents that consist mostly of one of its
blocks clearly say otherwise, they decide whether it is prose.  A document is not natural prose if more than half of its
characters other than blanks stand in blocks that are not.

The vocabulary and the word-order statistic are counted over all documents: the words that occur in at
least two and a share of ``KNOWN_SHARE`` of them (so their number is bounded by the words of a document over
that share), and how much more often two of the ``COMMON`` commonest follow each other than they would in any
order.  Each task adds up its own counts; only these lists are collected.  The texts are taken apart once, into a
staged table of tokens and blocks, which the counts and the verdicts read.  Letters of scripts written without
blanks count as a word each.  A block whose letters are in scripts that hardly any known word has says nothing
by its words being unknown; it gets the share of known words of the prose examples.

Null and blank texts get no verdict and no row.  Statistics that are undefined (no words, say) are
0.  Texts of any length are measured whole, repeated rows give one row each, an empty table none.
Without labelled rows the mixture is that of the inspected examples."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .canon import canonical

FEATURES = ("letter_share", "log_unit_words", "known_share", "order", "distinct_share", "digit_word_share", "ended_share", "log_words")
# Statistics read off inspected blocks, in the order of FEATURES, with what the blocks are.
EXAMPLES = (
    ("prose", (0.97, 2.5, 0.93, 2.6, 1.0, 0.01, 1.0, 4.0)),
    ("prose", (0.96, 2.3, 0.90, 2.6, 1.0, 0.03, 1.0, 2.6)),
    ("prose", (0.99, 4.2, 0.92, 2.5, 1.0, 0.02, 0.1, 4.2)),
    ("prose", (0.97, 2.0, 0.93, 2.6, 1.0, 0.02, 0.8, 4.0)),
    ("prose", (0.78, 2.8, 0.72, 2.0, 0.75, 0.26, 1.0, 5.2)),
    ("prose", (0.88, 2.4, 0.70, 1.3, 1.0, 0.10, 1.0, 2.6)),
    ("prose", (0.90, 2.4, 0.52, 1.0, 0.98, 0.08, 0.8, 3.9)),
    ("list", (0.93, 1.3, 0.85, 2.4, 0.95, 0.05, 0.0, 4.0)),
    ("list", (0.90, 1.2, 0.75, 2.2, 0.98, 0.15, 0.3, 4.3)),
    ("list", (0.90, 1.2, 0.85, 2.4, 0.95, 0.05, 1.0, 4.0)),
    ("table", (0.45, 2.0, 0.15, 1.0, 0.95, 0.65, 0.1, 4.5)),
    ("table", (0.55, 1.2, 0.20, 1.0, 0.95, 0.60, 0.9, 4.5)),
    ("table", (0.55, 2.3, 0.45, 1.5, 0.85, 0.55, 0.0, 4.5)),
    ("junk", (0.60, 2.2, 0.03, 1.0, 1.0, 0.60, 0.1, 3.6)),
    ("junk", (0.75, 1.8, 0.25, 1.0, 0.9, 0.05, 0.2, 4.6)),
    ("junk", (0.95, 3.5, 0.70, 0.3, 1.0, 0.05, 0.1, 4.6)),
    ("junk", (0.90, 2.4, 0.60, 2.5, 0.1, 0.20, 0.0, 4.8)),
    ("junk", (0.88, 2.6, 0.03, 1.0, 1.0, 0.15, 0.0, 4.0)),
)
PROSE_KNOWN = 0.9
_PARAGRAPH = re.compile(r"\n[ ]*\n\s*")
_DENSE = "\u0e00-\u0e7f\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"  # scripts written without blanks
_WORD = re.compile(rf"[{_DENSE}]|[^\W_{_DENSE}]+")
# Blanks and commas begin no token, so they may be passed over together with the token before them.
_TOKEN = re.compile(rf"([^\W_{_DENSE}]+|[{_DENSE}]|\n(?:[ ]*(?:[-*•‣·+]|\d+[.)])[ ])?|[。]+|(?<=[{_DENSE}])[!?]+|[.!?…;]+(?=[\s\"'”»)]|$))[ ,]*")
COMMON, KNOWN_IN, STRENGTH = 1000, 2, 20.0
# Fixed value: the share of the documents that hold a known word; words of copied junk are rarer.
KNOWN_SHARE = 0.004
# The texts, and about the characters, that are taken apart and measured together.
PART, PART_CHARS = 500, 1_000_000
WORDS_OF_INTEREST = 200


class Vocabulary:
    """Known words, and order statistics of the common ones."""

    def __init__(self, known: list[str], counts: list[tuple[int, int, int]]):
        """``known``: the most frequent first.  ``counts``: (word, next word, n) of common words, with -1
        as the next word how often the word occurs, with -1 twice the number of all words."""
        self.ids = {w: i for i, w in enumerate(known)}
        # the blocks of 128 code points whose letters known words are written in
        pages = Counter(ord(w[0]) >> 7 for w in known)
        self.scripts = {p for p, n in pages.items() if n >= 5}
        k = min(COMMON, len(known)) + 1
        pairs, single, total = np.zeros((k, k), np.float64), np.zeros(k), 1
        a, b, n = np.array(counts, np.int64).reshape(-1, 3).T
        pairs[a[b >= 0], b[b >= 0]] = n[b >= 0]
        single[a[(a >= 0) & (b < 0)]] = n[(a >= 0) & (b < 0)]
        total += int(n[a < 0].sum())
        expected = single[:, None] * single[None, :] / total
        self.order = np.log((pairs + 1) / (expected + 1)).astype(np.float32)
        self.order[k - 1, :] = self.order[:, k - 1] = np.nan


def take_apart(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The tokens that occur in the texts; all tokens in order, as their numbers there; and a row (number of
    the text, tokens, characters other than blanks) per block."""
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__
    tokens, blocks = [], []
    for i, t in enumerate(texts):
        if not t:
            continue
        for b in _PARAGRAPH.split(canonical(t).strip()):
            if not b:
                continue
            found = _TOKEN.findall(b)
            tokens += found
            blocks.append((i, len(found), len(b) - b.count(" ") - b.count("\n")))
    codes = np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))
    return list(number), codes, np.array(blocks, np.int64).reshape(-1, 3)


class Words(dict):
    """Token to its word in lower case, "" if that has a digit (as the number of a list mark), None if it is none."""

    def __missing__(self, token: str) -> str | None:
        if len(self) > 500_000:
            self.clear()
        if token.isalpha():
            w = token.lower()
        elif any(c.isdigit() for c in token):
            w = ""
        else:
            w = token.lower() if _WORD.match(token) else None
        self[token] = w
        return w


def _parts(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of at most ``PART`` texts, which end where they come to ``PART_CHARS`` characters."""
    begin = chars = 0
    for i, t in enumerate(texts, 1):
        chars += len(t or "")
        if i - begin == PART or chars >= PART_CHARS or i == len(texts):
            yield begin, i
            begin, chars = i, 0


def _apart_schema(id_type: str) -> str:
    return f"texts int, ids array<{id_type}>, tokens string, codes binary, blocks binary, word string, n long, seen long"


def _taken_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (texts, ids, tokens, codes, blocks) per part, as ``take_apart`` has them; and rows (word, n, seen)
    of the partition: how often a word without a digit occurs, and in how many texts."""
    words, counts = Words(), {}
    names = ["texts", "ids", "tokens", "codes", "blocks", "word", "n", "seen"]

    def counted(id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        rows = [(w, n, seen) for w, (n, seen) in counts.items()]
        counts.clear()
        for b in range(0, len(rows), 10_000):
            word, n, seen = zip(*rows[b : b + 10_000])
            none = [pa.nulls(len(word), t) for t in (pa.int32(), pa.list_(id_type), pa.string(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(word, pa.string()), pa.array(n, pa.int64()), pa.array(seen, pa.int64())], names)

    batch = None
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for begin, end in _parts(texts):
            tokens, codes, blocks = take_apart(texts[begin:end])
            ids = pa.ListArray.from_arrays(pa.array([0, end - begin], pa.int32()), batch.column(0).slice(begin, end - begin))
            row = [pa.array([end - begin], pa.int32()), ids, pa.array(["\0".join(tokens)], pa.string()), pa.array([codes.tobytes()], pa.binary()), pa.array([blocks.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays([*row, *(pa.nulls(1, t) for t in (pa.string(), pa.int64(), pa.int64()))], names)
            number: defaultdict[str, int] = defaultdict()
            number.default_factory = number.__len__
            of = np.array([number[w] if w else -1 for w in map(words.__getitem__, tokens)], np.int64)
            word, text = of[codes], np.repeat(blocks[:, 0], blocks[:, 1])
            word, text = word[word >= 0], text[word >= 0]
            k = len(number)
            once = np.sort(text * k + word)
            once = once[np.r_[True, once[1:] != once[:-1]][: len(once)]]
            n, seen = np.bincount(word, minlength=k), np.bincount(once % max(k, 1), minlength=k)
            for w, a, b in zip(number, n.tolist(), seen.tolist()):
                before = counts.get(w, (0, 0))
                counts[w] = before[0] + a, before[1] + b
            if len(counts) > 500_000:
                yield from counted(batch.column(0).type)
    if batch is not None:
        yield from counted(batch.column(0).type)


def _stored(batch: pa.RecordBatch) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """What ``take_apart`` gave, of each row of (tokens, codes, blocks)."""
    for tokens, codes, blocks in zip(*(batch.column(c).to_pylist() for c in ("tokens", "codes", "blocks"))):
        yield tokens.split("\0") if tokens else [], np.frombuffer(codes, np.int32), np.frombuffer(blocks, np.int64).reshape(-1, 3)


def _count_pairs(common):
    """(a, b, n) as ``Vocabulary`` takes them, of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, k = {w: i for i, w in enumerate(common.value)}, len(common.value) + 1
        words, pairs, single, total, waiting, held = Words(), np.zeros(k * k, np.int64), np.zeros(k, np.int64), 0, [], 0
        for batch in batches:
            for tokens, codes, blocks in _stored(batch):
                of = np.array([-1 if w is None else at.get(w, k - 1) for w in map(words.__getitem__, tokens)], np.int64)
                a, text = of[codes], np.repeat(blocks[:, 0], blocks[:, 1])
                a, text = a[a >= 0], text[a >= 0]
                waiting.append((a[:-1] * k + a[1:])[(text[1:] == text[:-1]) & (a[:-1] < k - 1) & (a[1:] < k - 1)])
                held += len(waiting[-1])
                single += np.bincount(a, minlength=k)
                total += len(a)
                if held > k * k:
                    pairs += np.bincount(np.concatenate(waiting), minlength=k * k)
                    waiting, held = [], 0
        pairs += np.bincount(np.concatenate([np.zeros(0, np.int64), *waiting]), minlength=k * k)
        found = np.nonzero(pairs)[0]
        a, b = np.r_[found // k, np.arange(k - 1), -1], np.r_[found % k, np.full(k, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(np.r_[pairs[found], single[: k - 1], total], pa.int64())], ["a", "b", "n"])

    return run


def taken_apart(rows: DataFrame) -> DataFrame:
    """A table (id, text) without null texts taken apart, once: its parts and the counts of its words."""
    return staged(rows.mapInArrow(_taken_apart, _apart_schema(rows.schema[0].dataType.simpleString())))


def vocabulary_of(texts: DataFrame, apart: DataFrame | None = None) -> Vocabulary:
    """The vocabulary of all texts, a table of one column without nulls; ``apart`` is what ``taken_apart`` made of it."""
    apart = taken_apart(texts.select(F.lit(0).alias("id"), texts.columns[0])) if apart is None else apart
    number = apart.agg(F.sum("texts")).first()[0] or 0
    counted = apart.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    known = [r["word"] for r in counted.where(F.col("seen") >= max(KNOWN_IN, KNOWN_SHARE * number)).orderBy(F.desc("n"), "word").collect()]
    common = apart.sparkSession.sparkContext.broadcast(known[:COMMON])
    pairs = apart.where("codes IS NOT NULL").select("tokens", "codes", "blocks").mapInArrow(_count_pairs(common), "a int, b int, n long")
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    return Vocabulary(known, list(zip(*(counts[c].to_pylist() for c in ("a", "b", "n")))))


class TokenIds(dict):
    """Token to a number: known word, -1 unknown word, -2 word with a digit, -3 line end, -4 line end
    before a list mark, -5 end of a sentence, -6 unknown word of a script no known word has; doubled, plus
    1 if the token begins in lower case."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.known, self.scripts = vocabulary.ids, vocabulary.scripts

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        c = token[0]
        if c == "\n":
            i = -3 if len(token) == 1 else -4
        elif not c.isalnum():
            i = -5
        else:
            i = self.known.get(token.lower())
            if i is None:
                i = -2 if not token.isalpha() and any(x.isdigit() for x in token) else -1 if ord(c) >> 7 in self.scripts or not self.scripts else -6
        self[token] = i = 2 * i + c.islower()
        return i


def measure(texts: int, tokens: list[str], codes: np.ndarray, blocks_of: np.ndarray, vocabulary: Vocabulary, ids: TokenIds) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of so many texts that ``take_apart`` took apart: features of the blocks of all texts, the block's text
    number and characters, and per text (words, letters in words, symbols, lines, ended lines, common words,
    characters)."""
    per_text = np.zeros((texts, 7))
    if not len(blocks_of):
        return np.zeros((0, len(FEATURES))), np.zeros(0, np.int64), np.zeros(0), per_text
    own, size, char = blocks_of[:, 0], blocks_of[:, 1], blocks_of[:, 2].astype(float)
    n, blocks = len(codes), len(size)
    kinds = np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens))
    kind = kinds[codes]
    length = np.fromiter(map(len, tokens), np.int64, len(tokens))[codes]
    lower, kind = (kind & 1).astype(bool), kind >> 1
    foreign = kind == -6
    kind[foreign] = -1
    block = np.repeat(np.arange(blocks), size)
    per = lambda mask, w=None: np.bincount(block[mask], None if w is None else w[mask], blocks)
    word = (kind >= 0) | (kind == -1) | (kind == -2)
    words = per(word)
    w1 = np.maximum(words, 1)
    # lines: a break is soft where the text runs on, as in wrapped prose
    line_end = (kind == -3) | (kind == -4)
    line = np.cumsum(line_end | np.r_[True, block[1:] != block[:-1]][: n]) - 1 if n else np.zeros(0, np.int64)
    line_len = np.bincount(line, (length + 1) * word) if n else np.zeros(0)
    line_block = np.zeros(len(line_len), np.int64)
    line_block[line] = block
    widest = np.zeros(blocks)
    np.maximum.at(widest, line_block, line_len)
    at = np.nonzero(kind == -3)[0]
    before, after = np.maximum(at - 1, 0), np.minimum(at + 1, n - 1)
    wrapped = (line_len[np.maximum(line[at] - 1, 0)] >= 0.7 * widest[block[at]]) & (widest[block[at]] >= 30)
    soft = (kind[before] != -5) & (lower[after] | wrapped) & word[after]
    hard = line_end.copy()
    hard[at[soft]] = False
    ended = kind == -5
    cut = hard | ended
    # units are what stands between cuts; empty ones do not count
    unit = np.cumsum(np.r_[True, cut[:-1] | (block[1:] != block[:-1])]) - 1 if n else np.zeros(0, np.int64)
    unit_words = np.bincount(unit, word) if n else np.zeros(0)
    unit_block, unit_ended = np.zeros(len(unit_words), np.int64), np.zeros(len(unit_words), bool)
    unit_block[unit] = block
    unit_ended[unit[ended]] = True
    real = unit_words > 0
    units = np.maximum(np.bincount(unit_block[real], minlength=blocks), 1)
    mean_log = np.log(np.maximum(words, 1) / units)
    # order and repetition
    both = word[:-1] & word[1:] & (block[1:] == block[:-1]) if n > 1 else np.zeros(0, bool)
    k = len(vocabulary.order)
    common = np.where((kind >= 0) & (kind < k - 1), kind, k - 1)
    pair = vocabulary.order[common[:-1], common[1:]] if n > 1 else np.zeros(0, np.float32)
    good = both & ~np.isnan(pair)
    pairs = np.bincount(block[:-1][good], minlength=blocks) if n > 1 else np.zeros(blocks)
    order = np.where(pairs >= 3, (np.bincount(block[:-1][good], pair[good], blocks) if n > 1 else 0) / np.maximum(pairs, 1), 1.0)
    at = np.nonzero(word)[0]
    code = kind[at] * 1009 + length[at]
    if foreign.any():
        looks = np.zeros(len(tokens), np.int64)
        for i in np.nonzero(kinds >> 1 == -6)[0].tolist():
            looks[i] = 1_000_003 * ord(tokens[i][0]) + ord(tokens[i][-1])
        code += looks[codes[at]]
    three = (code[:-2] * 31 + code[1:-1]) * 1_000_003 + code[2:] if len(at) > 2 else np.zeros(0, np.int64)
    wb = block[at]
    same = wb[:-2] == wb[2:] if len(at) > 2 else np.zeros(0, bool)
    if same.any():
        in_block = wb[:-2][same]
        key = np.sort((in_block.astype(np.uint64) << np.uint64(40)) | (three[same].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)))
        of = (key[np.r_[True, key[1:] != key[:-1]]] >> np.uint64(40)).astype(np.int64)
        threes = np.bincount(in_block, minlength=blocks)
        distinct = np.bincount(of, minlength=blocks) / np.maximum(threes, 1)
        distinct[threes < 8] = 1.0
    else:
        distinct = np.ones(blocks)
    in_words = per(word, length)
    digits = per(kind == -2)
    letters = per((kind >= 0) | (kind == -1), length)
    known = np.where(per(foreign) > 0.5 * w1, PROSE_KNOWN, per(kind >= 0) / w1)
    features = np.stack([letters / np.maximum(char, 1), mean_log, known, order, distinct, digits / w1, np.bincount(unit_block[real & unit_ended], minlength=blocks) / units, np.log1p(words)], 1)
    lines_all = np.bincount(line_block, line_len > 0, blocks) if n else np.zeros(blocks)
    last = np.r_[line[1:] != line[:-1], True] if n else np.zeros(0, bool)
    ended_line = np.bincount(block[last & ended], minlength=blocks) + np.bincount(block[np.maximum(np.nonzero(line_end)[0] - 1, 0)][kind[np.maximum(np.nonzero(line_end)[0] - 1, 0)] == -5], minlength=blocks)
    for j, v in enumerate((words, in_words, char - in_words, lines_all, np.minimum(ended_line, lines_all), per((kind >= 0) & (kind < WORDS_OF_INTEREST)), char)):
        per_text[:, j] = np.bincount(own, v, texts)
    return features, own, char, per_text


class Mixture:
    """A Gaussian mixture with full, regularised covariances.  ``other`` says of a block that makes up most of
    its document whether that is labelled as not prose; NaN says nothing."""

    def __init__(self, x: np.ndarray, other: np.ndarray | None = None, rounds: int = 40):
        examples = np.array([e[1] for e in EXAMPLES])
        data = np.concatenate([x, examples])
        self.mean, self.std = data.mean(0), np.maximum(data.std(0), 1e-3)
        z, anchor = (x - self.mean) / self.std, (examples - self.mean) / self.std
        k, d = anchor.shape
        mu, cov, weight = anchor.copy(), np.stack([np.eye(d) * 0.3] * k), np.full(k, 1 / k)
        for _ in range(rounds):
            self.mu, self.chol, self.log_weight = mu, np.linalg.cholesky(cov), np.log(weight)
            r = self.responsibility(z)
            n = r.sum(0) + 1e-9
            mu = (r.T @ z + STRENGTH * anchor) / (n + STRENGTH)[:, None]
            for j in range(k):
                c = z - mu[j]
                cov[j] = ((r[:, j, None] * c).T @ c + STRENGTH * 0.3 * np.eye(d)) / (n[j] + STRENGTH) + 0.02 * np.eye(d)
            weight = (n + STRENGTH) / (n + STRENGTH).sum()
        self.mu, self.chol, self.log_weight = mu, np.linalg.cholesky(cov), np.log(weight)
        own = self.responsibility(anchor)
        first = [e[0] for e in EXAMPLES]
        score = {c: own[[n == c for n in first]].sum(0) for c in ("prose", "list", "table", "junk")}
        self.names = [max(score, key=lambda c: score[c][j]) for j in range(k)]
        if other is not None and len(x):
            r = self.responsibility(z)[~np.isnan(other)]
            seen, share = r.sum(0), (r * other[~np.isnan(other), None]).sum(0) / np.maximum(r.sum(0), 1e-9)
            for j in np.nonzero(seen >= STRENGTH)[0]:
                if share[j] > 0.7 and self.names[j] == "prose":
                    self.names[j] = max(("list", "table", "junk"), key=lambda c: score[c][j])
                elif share[j] < 0.3:
                    self.names[j] = "prose"

    def responsibility(self, z: np.ndarray) -> np.ndarray:
        logs = np.empty((len(z), len(self.mu)))
        for j, (m, c) in enumerate(zip(self.mu, self.chol)):
            s = np.linalg.inv(c) @ (z - m).T
            logs[:, j] = self.log_weight[j] - np.log(np.diag(c)).sum() - 0.5 * (s * s).sum(0)
        logs -= logs.max(1, keepdims=True)
        p = np.exp(logs)
        return p / p.sum(1, keepdims=True)

    def classes(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0, "U5")
        r = self.responsibility((x - self.mean) / self.std)
        kinds = ("prose", "list", "table", "junk")
        by = np.stack([r[:, [n == c for n in self.names]].sum(1) for c in kinds], 1)
        return np.array(kinds)[by.argmax(1)]


def _measured(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        ids = TokenIds(vocabulary)
        for batch in batches:
            x, own, char, per_text = measure(batch.num_rows, *take_apart(batch.column(1).to_pylist()), vocabulary, ids)
            # a label speaks for the block that makes up most of its document
            other = np.where(2 * char > per_text[own, 6], batch.column(0).to_numpy(zero_copy_only=False)[own], np.nan)
            yield pa.RecordBatch.from_arrays([pa.array(other), *(pa.array(c) for c in x.T)], ["other", *FEATURES])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id_col: str, label_col: str, train_docs: int = 2000, apart: DataFrame | None = None) -> tuple[Vocabulary, Mixture]:
    """The vocabulary of all documents (``apart``: their texts, taken apart), and the mixture fitted on the blocks of at most ``train_docs`` labelled ones."""
    known = labels.where(F.col(label_col).isin("prose", "other")).groupBy(F.col(label_id_col).alias("i")).agg(F.avg((F.col(label_col) == "other").cast("double")).alias("other"))
    chosen = known.orderBy(F.xxhash64("i"), "i").limit(train_docs)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL").join(F.broadcast(chosen), "i").dropDuplicates(["i"]).select("other", "t")
    vocabulary = vocabulary_of(docs.select(F.col(text_col).alias("t")).where("t IS NOT NULL"), apart)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    found = rows.mapInArrow(_measured(shared), "other double, " + ", ".join(f"{f} double" for f in FEATURES)).toArrow()
    table = np.array([c.to_numpy() for c in found.columns]).T.reshape(-1, 1 + len(FEATURES))
    table = table[np.lexsort(table.T[::-1])]  # the order of the rows does not matter to the fit
    return vocabulary, Mixture(table[:, 1:], table[:, 0])


def _judge(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, mixture = model.value
        ids = TokenIds(vocabulary)
        for batch in batches:
            for id_list, stored in zip(batch.column("ids"), _stored(batch)):
                n = len(id_list)
                x, own, char, s = measure(n, *stored, vocabulary, ids)
                kinds = mixture.classes(x)
                shares = np.stack([np.bincount(own, char * (kinds == k), n) for k in ("prose", "list", "table", "junk")], 1) / np.maximum(s[:, 6:7], 1)
                keep = np.nonzero(s[:, 6] > 0)[0]
                div = lambda a, c: (s[keep, a] / np.maximum(s[keep, c], 1))
                other = 1 - shares[keep, 0]
                yield pa.RecordBatch.from_arrays(
                    [id_list.values.take(pa.array(keep)), pa.array(s[keep, 0].astype(np.int64)), *map(pa.array, (div(1, 0), div(2, 6), div(4, 3), div(5, 0), *shares[keep].T)), pa.array(np.where(other > 0.5, np.array(["list", "table", "junk"])[shares[keep, 1:].argmax(1)], "prose").tolist(), pa.string())],
                    ["id", "word_count", "mean_word_length", "symbol_ratio", "punct_line_share", "common_word_share", "prose_share", "list_share", "table_share", "junk_share", "verdict"],
                )

    return run


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "quality", train_docs: int = 2000) -> DataFrame:
    """(id, statistics, shares of the kinds of text, verdict) of every text that is not blank."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    apart = taken_apart(rows)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, label_id_col, label_col, train_docs, apart))
    stats = "word_count long, mean_word_length double, symbol_ratio double, punct_line_share double, common_word_share double, prose_share double, list_share double, table_share double, junk_share double, verdict string"
    return apart.where("codes IS NOT NULL").select("ids", "tokens", "codes", "blocks").mapInArrow(_judge(model), f"id {rows.schema['id'].dataType.simpleString()}, {stats}")
