"""Main body of web pages (problem 3) by line-block distribution.

Markup, if there is any, is stripped.  Every line weighs as many characters as it has, and nothing if
it is blank, the site's own, furniture or in a box of links.  The weights are summed over sliding
windows of ``window`` lines.  The text surges where a window's sum leaves zero and dives where
``window`` lines in a row weigh nothing; a stretch between surge and dive is body if it has running text or
a marked list and its heaviest window reaches a threshold taken from the page itself: ``surge`` times the
median length of the page's lines of running text.  A body without a headline of its own takes the short lines of the
stretch before it.  On a page without running text the items of its marked lists take its place.

No word of any language is known beforehand.  What is furniture is told from how lines recur:

* in the corpus: lines (digits are alike), their beginnings up to a colon and the last five words of rare
  lines are counted with where they stand: before and after running text, at the edges, early or late in the page.  A kind of line that
  recurs in enough different surroundings is furniture if these places differ from those of rare lines
  of its sort by more than ``differs`` (Kullback-Leibler divergence, and ``sure`` in all its
  occurrences); titles recur too, but stand where rare titles stand.  A recurring sentence always is,
  and so is a recurring part of rows of links.
* on the host, as a second signal: lines on enough of its pages (``short_share`` of them, of sentences
  ``long_share``).

Furniture that never stands before running text or at the end of a page, but does stand after running
text and mostly not early in a page, is a label: the short lines below it are a box, up to running text,
a marked list in a box without marks, a blank line or furniture.
Rows of links are furniture if most of their parts are.

The counts cover all pages, with partial aggregation on hashes of lines, so a host or line with a third
of all rows is no burden; texts are never shuffled unless the site lines of all hosts exceed
``broadcast_lines`` (8 bytes each).  Furniture of the corpus stands on a share of the pages, so there are at
most a few thousand times as many kinds as a page has lines, whatever the size of the corpus.

Null and blank texts have no row.  Pages without a host are judged by the corpus and the windows alone.
Repeated rows count once; an empty table gives none."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .canon import canonical

_SENTENCE = re.compile(r"(?:\S+\s+){3,}.*[.!?。！？…][\"'”»)\]]*$|.{20,}[。！？]$", re.S)
_PARTS = re.compile(r"\s+[|/»·>•]\s+|\s{2,}")
_MARKS = "|/»·>•"
_TAG = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[/a-zA-Z!][^<>]*>", re.S | re.I)
_MARK = re.compile(r"^(?:[*•‣·+-]|\d+[.)])\s+")
_DIGITS = re.compile(r"\d+")
_HEAD = re.compile(r"[^:：]{2,30} ?[:：](?=\s)")
LONG = 40
FURNITURE, LABEL = 1, 2
PLACES = ("before_text", "at_end", "after_text", "at_start", "early", "late")


def page_lines(text: str) -> list[str]:
    """Lines as shown, without markup and outer blanks; their number stays the number in ``text``."""
    if "</" in text or "<br" in text:
        text = _TAG.sub(lambda m: "\n" * m[0].count("\n"), text)
    return [canonical(x).strip() for x in text.split("\n")]


def is_sentence(line: str) -> bool:
    return bool(_SENTENCE.match(line)) and not line.endswith(" …")


def key_of(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def kind_of_line(line: str) -> str:
    """The line without list mark, case and the value of its numbers."""
    return _DIGITS.sub("0", _MARK.sub("", line).lower())


def kinds(line: str) -> list[str]:
    """What is counted of a line: itself and, of a short one, its beginning up to a colon."""
    whole = kind_of_line(line)
    return [whole, "^" + m[0]] if len(whole) < 100 and (m := _HEAD.match(whole)) else [whole]


def tail_of(whole: str) -> str | None:
    """The last five words of a longer line."""
    ws = whole.rsplit(None, 5)
    return "$ " + " ".join(ws[1:]) if len(ws) == 6 else None


def parts_of(line: str) -> list[str]:
    """The parts of a row of links; none for any other line."""
    if "  " not in line and not any(mark in line for mark in _MARKS):
        return []
    parts = [p for p in _PARTS.split(line) if p]
    return parts if len(parts) > 1 else []


class Furniture:
    """Keys of what recurs in the corpus and on hosts, with whether it is furniture or a label."""

    def __init__(self, corpus: dict[int, int], site: tuple[np.ndarray, np.ndarray] | None = None):
        self.corpus, self.site = corpus, site
        self.seen: dict[str, int] = {}

    def of_corpus(self, line: str) -> int:
        kind = self.seen.get(line)
        if kind is None:
            found = kinds(line)
            tail = tail_of(found[0])
            kind = max(self.corpus.get(key_of(k), 0) for k in ([*found, tail] if tail else found))
            if len(line) < 100:
                if len(self.seen) > 200_000:
                    self.seen.clear()
                self.seen[line] = kind
        return kind

    def of_site(self, host: str | None, line: str, known: dict[int, int] | None) -> int:
        if host is None:
            return 0
        key = key_of(f"{host}\n{kind_of_line(line)}")
        if known is not None:
            return known.get(key, 0)
        keys, values = self.site
        at = int(np.searchsorted(keys, key))
        return int(values[at]) if at < len(keys) and keys[at] == key else 0

    def of(self, host: str | None, line: str, known: dict[int, int] | None) -> int:
        if kind := self.of_corpus(line) or self.of_site(host, line, known):
            return kind
        parts = parts_of(line)
        return FURNITURE if parts and 2 * sum(1 for p in parts if self.is_part(host, p, known)) >= len(parts) else 0

    def is_part(self, host: str | None, part: str, known: dict[int, int] | None) -> bool:
        return bool(self.of_corpus(part) or self.of_corpus("| " + part) or self.of_site(host, part, known) or self.of_site(host, "| " + part, known))


def body(lines: list[str], kind: list[int], window: int = 3, surge: float = 0.25) -> list[int]:
    """Numbers of the lines of the main body; ``kind`` tells furniture and labels."""
    shown, running, free, marked, box, style = [], [], [], [], False, None
    for i, x in enumerate(lines):
        if not x:
            box = False
            continue
        prose, mark = not kind[i] and is_sentence(x), bool(_MARK.match(x))
        if kind[i]:
            box, style = kind[i] == LABEL, None
        elif prose or style is False and mark:  # a marked list is no part of a box without marks
            box = False
        elif style is None:
            style = mark
        shown.append(i)
        running.append(len(x) if prose else 0)
        free.append(0 if kind[i] or box else len(x))
        marked.append(len(x) if mark and not kind[i] and not box else 0)
    weight, text, items = np.array(free, float), np.array(running, float), np.array(marked, float)
    if not text.any():
        if not items.any():
            return []
        text = items
    sums = np.convolve(weight, np.ones(window))  # of the window that ends at each line, and beyond the last
    # a stretch holds the lines between a surge and a dive
    up = np.nonzero(sums > 0)[0]
    breaks = np.nonzero(np.diff(up) > 1)[0]
    first, last = up[np.r_[0, breaks + 1]], up[np.r_[breaks, len(up) - 1]]
    least = surge * float(np.median(text[text > 0]))
    stretches = [(int(a), int(b)) for a, b in zip(first, last - window + 1)]
    good = [sums[a : b + window].max() >= least and bool((text[a : b + 1] + items[a : b + 1]).any()) for a, b in stretches]
    if True not in good:
        return []
    top = good.index(True)
    if top > 0 and text[stretches[top][0]] and not text[stretches[top - 1][0] : stretches[top - 1][1] + 1].any():
        good[top - 1] = True
    return [shown[j] for (a, b), ok in zip(stretches, good) if ok for j in range(a, b + 1) if weight[j]]


class Facts(dict):
    """Of a line: whether it is running text, its hash, and the kinds counted of it; short lines recur and are remembered."""

    def __missing__(self, line: str) -> tuple[bool, int, list[tuple[str, int | None]]]:
        first, *more = kinds(line)
        tail = tail_of(first)
        found = [(first, key_of(tail) if tail else None), *((k, None) for k in more), *(("| " + kind_of_line(p), None) for p in parts_of(line))]
        known = (len(line) >= LONG and is_sentence(line), key_of(line), found)
        if len(line) < 100:
            if len(self) > 200_000:
                self.clear()
            self[line] = known
        return known


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, key on the host, key, sentence, n, places, surroundings, pages, part of a row) of a batch.
    Surroundings and pages are sketches: a bit each of 63."""
    facts = Facts()
    for batch in batches:
        index: dict[tuple, int] = {}
        at, places, around, of_page = [], [], [], []
        prose_of, part_of, tails = [], [], []
        for page, host, text in zip(*(c.to_pylist() for c in batch.columns)):
            lines = [facts[x] for x in page_lines(text) if x]
            n, seen = len(lines), set()
            for i, (prose, _, found) in enumerate(lines):
                after, before = lines[i + 1] if i + 1 < n else None, lines[i - 1] if i else None
                place = (after[0] if after else 0) | (not after) << 1 | (before[0] if before else 0) << 2 | (not before) << 3 | (3 * i < n) << 4 | (3 * i >= 2 * n) << 5
                near = ((before[1] if before else 0) * 3 + (after[1] if after else 0)) % 63
                for k, tail in found:
                    if k not in seen:
                        seen.add(k)
                        j = index.setdefault((host, k), len(index))
                        if j == len(prose_of):
                            prose_of.append(prose)
                            part_of.append(k[:2] == "| ")
                            tails.append(tail)
                        at.append(j)
                        places.append(place)
                        around.append(near)
                        of_page.append(page % 63)
        m, j, place = len(index), np.array(at, np.int64), np.array(places, np.int64)
        counts = [np.bincount(j, minlength=m)] + [np.bincount(j[(place >> b & 1).astype(bool)], minlength=m) for b in range(6)]
        sketches = [np.zeros(m, np.int64), np.zeros(m, np.int64)]
        for sketch, values in zip(sketches, (around, of_page)):
            np.bitwise_or.at(sketch, j, np.int64(1) << np.array(values, np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in index], pa.string()), pa.array([None if h is None else key_of(f"{h}\n{k}") for h, k in index], pa.int64()), pa.array([key_of(k) for _, k in index], pa.int64()),
             pa.array(prose_of, pa.bool_()), *map(pa.array, counts), *map(pa.array, sketches), pa.array(part_of, pa.bool_()), pa.array(tails, pa.int64())],
            ["host", "site", "key", "prose", "n", *PLACES, "around", "pages", "part", "tail"],
        )


_COUNTS = "host string, site long, key long, prose boolean, n long, " + ", ".join(f"{p} long" for p in PLACES) + ", around long, pages long, part boolean, tail long"


def _summed() -> list[Column]:
    return [F.max("prose").alias("prose"), F.sum("n").alias("n"), *[F.sum(p).alias(p) for p in PLACES], F.bit_or("around").alias("around"), F.bit_or("pages").alias("pages"), F.max("part").alias("part"), F.max("tail").alias("tail")]


def _shares(column: str, total: Column) -> list[Column]:
    """The shares of three exclusive places, given by the first two."""
    a, b = {"next": ("before_text", "at_end"), "previous": ("after_text", "at_start"), "where": ("early", "late")}[column]
    return [F.col(a) / total, F.col(b) / total, (total - F.col(a) - F.col(b)) / total]


def recurring(pages: DataFrame, short_share: float, long_share: float, least_pages: int, page_share: float, differs: float, sure: float) -> tuple[dict[int, int], DataFrame]:
    """Furniture of the corpus as {key: kind}, and of the hosts as a staged table (host, site, kind)."""
    counted = staged(pages.mapInArrow(_count, _COUNTS).groupBy("host", "site", "key").agg(*_summed()))
    label = (F.col("before_text") <= 0.02 * F.col("n")) & (F.col("at_end") <= 0.02 * F.col("n")) & (F.col("after_text") >= 0.05 * F.col("n")) & (F.col("early") <= 0.5 * F.col("n")) & ~F.col("prose")
    kind = F.when(label, LABEL).otherwise(FURNITURE).cast("int").alias("kind")
    sizes = pages.groupBy("host").agg(F.count("*").alias("of"))
    often = counted.where((F.col("n") >= 2) & F.col("site").isNotNull() & (F.bit_count("pages") > 1)).join(sizes, "host")
    site = often.where(((F.col("n") >= 3) & (F.col("n") >= F.col("of") * short_share)) | (F.col("prose") & (F.col("n") >= F.greatest(F.lit(2), F.col("of") * long_share)))).select("host", "site", kind)
    # rare lines of each sort, short ones and sentences, say where such lines stand
    kinds_ = staged(counted.groupBy("key").agg(*_summed()))
    total = sum(r["n"] for r in pages.groupBy().agg(F.count("*").alias("n")).collect())
    pools = {r["prose"]: r for r in kinds_.where("n <= 2 AND NOT part").groupBy("prose").agg(*[F.sum(c).alias(c) for c in ("n", *PLACES)]).collect()}
    least = max(least_pages, page_share * total)
    many = kinds_.where((F.col("n") >= least) & (F.bit_count("around") >= least_pages * 3 // 4))
    # endings of lines that are themselves rare, so that a recurring sentence does not stand for its ending
    tails = kinds_.where("n <= 2 AND tail IS NOT NULL").drop("key").withColumnRenamed("tail", "key").withColumn("tail", F.lit(None).cast("long")).groupBy("key").agg(*_summed())
    many = many.unionByName(tails.where((F.col("n") >= least) & (F.bit_count("around") >= least_pages * 3 // 4)).withColumn("ending", F.lit(True)), allowMissingColumns=True)
    smooth = 20.0
    away = F.lit(0.0)
    for name in ("next", "previous", "where"):
        for j in range(3):
            expected = F.lit(1 / 3)
            for prose, r in pools.items():
                a, b = {"next": ("before_text", "at_end"), "previous": ("after_text", "at_start"), "where": ("early", "late")}[name]
                there = (r[a], r[b], r["n"] - r[a] - r[b])[j]
                expected = F.when(F.col("prose") == prose, (there + 1) / (r["n"] + 3)).otherwise(expected)
            share = (_shares(name, F.col("n"))[j] * F.col("n") + smooth * expected) / (F.col("n") + smooth)
            away = away + F.when(share > 0, share * F.log(share / expected)).otherwise(0.0)
    found = many.where(((away >= differs) & (away * F.col("n") >= sure)) | (F.col("prose") & F.col("ending").isNull() & (F.col("n") >= 2 * least_pages)) | F.col("part")).select("key", kind)
    return {r["key"]: r["kind"] for r in found.collect()}, staged(site)


def _bodies(furniture, window: int, surge: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: Furniture = furniture.value
        for batch in batches:
            rows, numbers, texts = [], [], []
            site = batch.column(3).to_pylist() if batch.num_columns > 3 else None
            for r, (host, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                lines = page_lines(text)
                known = None if site is None else {s["site"]: s["kind"] for s in site[r] or ()}
                kept = body(lines, [f.of(host, x, known) if x else 0 for x in lines], window, surge)
                rows += [r] * len(kept)
                numbers += kept
                texts += [lines[i] for i in kept]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int64()), pa.array(texts, pa.string())], ["page_id", "line_no", "line"])

    return run


def main_lines(
    pages: DataFrame, id_col: str = "page_id", host_col: str = "host", text_col: str = "text", window: int = 3, surge: float = 0.25, short_share: float = 0.6, long_share: float = 0.1,
    least_pages: int = 5, page_share: float = 0.0005, differs: float = 0.26, sure: float = 6.0, broadcast_lines: int = 4_000_000,
) -> DataFrame:
    """(page_id, line_no, line): the lines of each page's main body."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(host_col).alias("host"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    spark = pages.sparkSession
    corpus, site = recurring(rows.select(F.xxhash64("page_id").alias("page"), "host", "t"), short_share, long_share, least_pages, page_share, differs, sure)
    schema = f"page_id {rows.schema['page_id'].dataType.simpleString()}, line_no long, line string"
    if site.count() <= broadcast_lines:
        found = site.select("site", "kind").toArrow()
        keys, values = found["site"].to_numpy(), found["kind"].to_numpy().astype(np.int8)
        order = np.argsort(keys)
        shared = spark.sparkContext.broadcast(Furniture(corpus, (keys[order], values[order])))
        return rows.mapInArrow(_bodies(shared, window, surge), schema)
    shared = spark.sparkContext.broadcast(Furniture(corpus))
    by_host = staged(site.groupBy("host").agg(F.collect_list(F.struct("site", "kind")).alias("known")))  # staged, so that a skewed host is split in the join
    return rows.join(by_host, "host", "left").select("page_id", "host", "t", "known").mapInArrow(_bodies(shared, window, surge), schema)


def main_text(pages: DataFrame, id_col: str = "page_id", host_col: str = "host", text_col: str = "text") -> DataFrame:
    """(page_id, body): each page's main body as one text."""
    lines = main_lines(pages, id_col, host_col, text_col).distinct()
    return lines.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("body"))
