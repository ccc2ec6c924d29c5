"""Words of languages written without blanks, and stop words for them.

Text is cut by the longest words of a lexicon that fit, forwards and backwards; the cut with fewer
pieces, then fewer single characters, then the backward one stays.  What no word covers is single
characters; runs of other letters and digits stay whole.  A lexicon is a set of words: the caller's, or
one made of a corpus by ``lexicon_of``."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expr import deferred

# Frequent function words.
STOP_WORDS = {
    "zh": "的 了 和 是 在 我 有 不 人 这 那 他 她 它 们 我们 你 也 就 都 而 与 及 或 但 但是 因为 所以 如果 一个 没有 到 说 要 去 会 着 上 下 对 从 把 被 给 让 很 更 最 还 又".split(),
    "ja": "の に は を が で と も へ や から まで より です ます した する いる ある なる こと これ それ あれ この その ない など だ な て し ので のに けれど しかし また そして よう ため".split(),
    "th": "ที่ และ ใน ของ มี ได้ ไม่ เป็น การ ว่า จะ ให้ กับ แต่ หรือ ก็ นี้ นั้น จาก โดย เมื่อ แล้ว อยู่ ไป มา ต้อง ความ คือ เพราะ ถ้า ซึ่ง ทำ".split(),
}
# Characters of scripts written without blanks; of Thai a character with the marks above and below it.
DENSE = "฀-๿぀-ヿ㐀-鿿豈-﫿"
_PIECE = re.compile(rf"[{DENSE}]+|[^\W{DENSE}]+")
_UNIT = re.compile("[ก-ะาำเ-ๆ][ัิ-ฺ็-๎]*|.", re.S)


def is_dense(language: str) -> bool:
    return language in STOP_WORDS


def _longest(units: list[str], words: frozenset[str], most: int, backward: bool) -> list[str]:
    out, n = [], len(units)
    at = n if backward else 0
    while at > 0 if backward else at < n:
        for size in range(min(most, at if backward else n - at), 0, -1):
            word = "".join(units[at - size : at] if backward else units[at : at + size])
            if size == 1 or word in words:
                out.append(word)
                at += -size if backward else size
                break
    return out[::-1] if backward else out


def split_words(text: str | None, words: frozenset[str] = frozenset(), most: int | None = None) -> list[str]:
    """Words of a text; characters that are neither letters nor digits are left out."""
    if not text:
        return []
    most = most or max(map(len, words), default=1)
    out = []
    for m in _PIECE.finditer(text):
        if not re.match(f"[{DENSE}]", m[0]):
            out.append(m[0])
            continue
        units = _UNIT.findall(m[0])
        one, two = (_longest(units, words, most, backward) for backward in (False, True))
        cost = lambda cut: (len(cut), sum(len(w) == 1 for w in cut))
        out += one if cost(one) < cost(two) else two
    return out


def word_list(words: frozenset[str] = frozenset()) -> Callable[[Column], Column]:
    """The words of a text as an array; null for null."""
    most = max(map(len, words), default=1)

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else split_words(t, words, most), na_action=None)

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return deferred(run, "array<string>")


def stop_word_density(language: str, words: frozenset[str] = frozenset()) -> Callable[[Column], Column]:
    """Share of stop words among the words of a text; the stop words belong to the lexicon."""
    stops = STOP_WORDS[language]
    split = word_list(words | frozenset(stops))
    return lambda text: F.try_divide(F.size(F.filter(split(text), lambda w: w.isin(*stops))).cast("double"), F.size(split(text)).cast("double"))


def lexicon_of(df: DataFrame, text_col: str = "text", most: int = 4, share: float = 0.0005, firm: float = 3.0) -> frozenset[str]:
    """Words of a corpus: strings of two to ``most`` characters that stand in at least a ``share`` of the
    texts (which bounds their number) and occur ``firm`` times as often as their halves would together by chance."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: dict[str, int] = {}
            seen: dict[str, int] = {}
            for text in batch.column(0).to_pylist():
                mine: dict[str, int] = {}
                for run in re.findall(f"[{DENSE}]+", text):
                    for size in range(1, most + 1):
                        for i in range(len(run) - size + 1):
                            g = run[i : i + size]
                            mine[g] = mine.get(g, 0) + 1
                for g, k in mine.items():
                    n[g] = n.get(g, 0) + k
                    seen[g] = seen.get(g, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["gram", "n", "seen"])

    rows = df.select(F.col(text_col).alias("t")).where("t IS NOT NULL")
    least = max(2.0, share * rows.count())
    grams = rows.mapInArrow(count, "gram string, n long, seen long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")).where(F.col("seen") >= least)
    n = {r["gram"]: r["n"] for r in grams.collect()}
    total = sum(k for g, k in n.items() if len(g) == 1)
    chance = lambda g: max(n.get(g[:i], 1) * n.get(g[i:], 1) for i in range(1, len(g))) / max(total, 1)
    return frozenset(g for g, k in n.items() if len(g) > 1 and k >= firm * chance(g))
