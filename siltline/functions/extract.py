"""Text from HTML, wiki markup, LaTeX and notebooks, and layout strings to elements."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expr import deferred, ratio, words
from .scores import Markup, _batched

# Tags that begin a new block of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br caption center col colgroup dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol optgroup option p pre section table tbody td textarea tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SKIPPED = frozenset("script style head noscript template header svg iframe object embed".split())
# Frequent words of some languages, for the density of function words.
STOP_WORDS = {
    "en": "the of and to a in is that it was for on are as with his they i at be this have from or one had by but not what all were we when your can said there an each which she do how their if will up other about out many then them these so some her would make like him into has two more go no way could my than first been call who its now find long down did get come made may".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont la avec son mais ou aux l d elle nous vous cette ont été comme on être fait ses leur".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante".split(),
    "pt": "de a o que e do da em um para é com não uma os no se na por mais as dos como mas foi ao ele das tem à seu sua ou ser quando muito há nos já está eu também só pelo pela até isso".split(),
    "it": "di e il la che in a per è un una non sono le con i del si da al dei nel come più alla della ma anche o lo gli ha su delle questo se dal essere stato".split(),
    "nl": "de van het een en in is dat op te zijn met voor niet aan er om ook als dan maar bij door uit over naar heeft tot worden deze die nog wordt".split(),
    "ru": "и в не на я быть он с что а по это она этот к но они мы весь который из у то за свой от так о для ты же все год как".split(),
}
UNSPACED = frozenset(("zh", "ja", "th", "ko"))


@dataclass
class Block:
    """A piece of text between block tags."""

    text: str = ""
    linked: int = 0
    heading: bool = False
    path: str = ""
    kind: str = ""
    chars: list[str] = field(default_factory=list)


class _Blocks(Markup):
    """Collects blocks with the characters that stand in links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.now, self.skip, self.links, self.head = Block(), 0, 0, 0

    def close_block(self) -> None:
        if not self.now.chars:
            self.now.heading = self.head > 0
            return
        text = " ".join("".join(self.now.chars).split())
        if text:
            self.now.text = text
            self.blocks.append(self.now)
        self.now = Block(heading=self.head > 0)

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skip += 1
        if tag in BLOCK_TAGS:
            self.head += tag in HEADINGS
            self.close_block()
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self.close_block()

    def handle_endtag(self, tag):
        if tag in SKIPPED and self.skip:
            self.skip -= 1
        if tag in HEADINGS and self.head:
            self.close_block()
            self.head -= 1
            self.now.heading = self.head > 0
        elif tag in BLOCK_TAGS:
            self.close_block()
        if tag == "a" and self.links:
            self.links -= 1

    def handle_data(self, data):
        if not self.skip:
            self.now.chars.append(data)
            self.now.linked += len(data) if self.links else 0


def html_blocks(html: str) -> list[Block]:
    p = _Blocks()
    p.feed(html)
    p.close()
    p.close_block()
    return p.blocks


def _parsed(html: str | list[Block]) -> list[Block]:
    return html_blocks(html) if isinstance(html, str) else html


MARKS = ".,;:!?\"'()"


def stop_density(text: str, stop: frozenset[str]) -> float:
    ws = text.lower().split()
    return sum(w.strip(MARKS) in stop for w in ws) / len(ws) if ws else 0.0


def block_texts(html: str | list[Block], stop: frozenset[str], spaced: bool = True, length_low: int = 70, length_high: int = 200, stop_low: float = 0.30, stop_high: float = 0.32, link_limit: float = 0.2, heading_distance: int = 200, no_headings: bool = False) -> list[str]:
    """Main text by the published rules for blocks: each is judged by its length, the density of stop
    words and of links; short and doubtful ones then follow their neighbours, and short headings near
    good text stay.  Languages without spaces keep every block."""
    blocks = _parsed(html)
    if not spaced:
        return [b.text for b in blocks]
    for b in blocks:
        n = len(b.text)
        if b.linked / n > link_limit or "©" in b.text or "&copy" in b.text:
            b.kind = "bad"
        elif n < length_low:
            b.kind = "bad" if b.linked else "short"
        elif (density := stop_density(b.text, stop)) >= stop_high:
            b.kind = "good" if n > length_high else "neargood"
        else:
            b.kind = "neargood" if density >= stop_low else "bad"
    first = [b.kind for b in blocks]

    def near_good(i: int) -> bool:
        distance = 0
        for b, k in zip(blocks[i + 1 :], first[i + 1 :]):
            if distance > heading_distance:
                return False
            if k == "good":
                return True
            distance += len(b.text)
        return False

    kinds = list(first)
    if not no_headings:
        kinds = ["neargood" if k == "short" and b.heading and near_good(i) else k for i, (b, k) in enumerate(zip(blocks, kinds))]

    def neighbour(at: list[str], i: int, step: int, through_near: bool) -> str:
        i += step
        while 0 <= i < len(at):
            if at[i] in ("good", "bad") or (not through_near and at[i] == "neargood"):
                return at[i]
            i += step
        return "bad"

    settled = list(kinds)
    for i, k in enumerate(kinds):
        if k == "short":
            a, b = neighbour(kinds, i, -1, True), neighbour(kinds, i, 1, True)
            near = "neargood" in (neighbour(kinds, i, -1, False), neighbour(kinds, i, 1, False))
            settled[i] = a if a == b else "good" if near else "bad"
    final = list(settled)
    for i, k in enumerate(settled):
        if k == "neargood":
            final[i] = "bad" if neighbour(settled, i, -1, True) == neighbour(settled, i, 1, True) == "bad" else "good"
    if not no_headings:
        for i, b in enumerate(blocks):
            if b.heading and final[i] == "bad" and first[i] != "bad":
                distance = 0
                for c, k in zip(blocks[i + 1 :], final[i + 1 :]):
                    if distance > heading_distance:
                        break
                    if k == "good":
                        final[i] = "good"
                        break
                    distance += len(c.text)
    return [b.text for b, k in zip(blocks, final) if k == "good"]


def dense_blocks(html: str | list[Block], stop: frozenset[str], spaced: bool = True, least: float = 0.32) -> list[str]:
    """Blocks whose density of stop words is at least ``least``."""
    return [b.text for b in _parsed(html) if not spaced or stop_density(b.text, stop) >= least]


def largest_text(html: str | list[Block], stop: frozenset[str], spaced: bool = True, least: float = 0.32, shortest: int = 25) -> list[str] | None:
    """Blocks that are neither short nor mostly links, then the density rule; none gives None."""
    kept = [b.text for b in _parsed(html) if b.heading or (len(b.text) >= shortest and b.linked * 2 <= len(b.text))]
    kept = [t for t in kept if not spaced or stop_density(t, stop) >= least]
    return kept or None


ALGORITHMS: dict[str, Callable] = {"blocks": block_texts, "density": dense_blocks, "largest": largest_text}


def decode_html(content: bytes | None) -> str | None:
    """By UTF-8, else by a charset in the head, else by windows-1252."""
    if content is None:
        return None
    try:
        return content.decode("utf-8")
    except UnicodeDecodeError:
        m = re.search(rb"charset=[\"']?([\w-]+)", content[:2048])
        for codec in ([m[1].decode("ascii")] if m else []) + ["windows-1252", "latin-1"]:
            try:
                return content.decode(codec)
            except (UnicodeDecodeError, LookupError):
                continue
    return None


_STOPS = {k: frozenset(v) for k, v in STOP_WORDS.items()}


def guess_language(text: str) -> str | None:
    """The language whose stop words are densest, if they are a tenth of the words at least."""
    ws = text.lower().split()
    counts = Counter(w.strip(MARKS) for w in ws)
    found = {k: sum(counts[w] for w in stop if w in counts) for k, stop in _STOPS.items()}
    best = max(found, key=found.__getitem__)
    return best if ws and found[best] / len(ws) >= 0.1 else None


def html_text(algorithm: str = "blocks", stop_lists: dict[str, list[str]] | None = None, **options) -> Callable[[Column], Column]:
    """A struct (language, text) of an HTML column: the language is detected, its stop list is required,
    and blocks are joined by blank lines; null where there is no language or no text."""
    lists = {k: frozenset(v) for k, v in (stop_lists or STOP_WORDS).items()}
    extract = ALGORITHMS[algorithm]

    def one(html: str | None) -> tuple[str | None, str | None]:
        if not html:
            return None, None
        blocks = html_blocks(html)
        language = guess_language(" ".join(b.text for b in blocks))
        if language not in lists:
            return None, None
        found = extract(blocks, lists[language], language not in UNSPACED, **options)
        return (language, "\n\n".join(found)) if found else (None, None)

    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(p) for p in pages], columns=["language", "text"])

    run.__annotations__ = {"pages": pd.Series, "return": pd.DataFrame}
    return deferred(run, "language string, text string", once=True)


def stop_word_density(text: Column, language: str = "en") -> Column:
    """Share of words that are stop words, as a Catalyst expression."""
    ws = words(F.lower(text))
    return ratio(F.size(F.filter(ws, lambda w: w.isin(*STOP_WORDS[language]))), F.size(ws))


# --- wiki markup ---------------------------------------------------------------------------------

# Names of the media and category namespaces.
MEDIA = {"en": "File|Image|Media", "de": "Datei|Bild|File|Image|Media", "fr": "Fichier|Image|File|Media", "es": "Archivo|Imagen|File|Image|Media", "ru": "Файл|Изображение|File|Image|Media", "it": "File|Immagine|Image|Media", "nl": "Bestand|Afbeelding|File|Image|Media", "pt": "Ficheiro|Imagem|File|Image|Media"}
CATEGORY = {"en": "Category", "de": "Kategorie|Category", "fr": "Catégorie|Category", "es": "Categoría|Category", "ru": "Категория|Category", "it": "Categoria|Category", "nl": "Categorie|Category", "pt": "Categoria|Category"}


def _balanced(text: str, opened: str, closed: str, replace: Callable[[str], str]) -> str:
    """Replace outermost balanced pairs; an unclosed one stays."""
    out, depth, start, at = [], 0, 0, 0
    for m in re.finditer(f"{re.escape(opened)}|{re.escape(closed)}", text):
        if m[0] == opened:
            if depth == 0:
                out.append(text[at : m.start()])
                start = m.start()
            depth += 1
        elif depth:
            depth -= 1
            if depth == 0:
                at = m.end()
                out.append(replace(text[start:at]))
    return "".join(out) + (text[start:] if depth else text[at:])


def wiki_text(source: str | None, language: str = "en") -> str | None:
    """Plain text of an article: templates, tables, references and media links go, other links leave
    their label, sections are separated by blank lines."""
    if not source:
        return None
    media, category = re.compile(rf"\[\[\s*(?:{MEDIA.get(language, MEDIA['en'])})\s*:", re.I), re.compile(rf"^\s*(?:{CATEGORY.get(language, 'Category')})\s*:", re.I)
    t = re.sub(r"<!--.*?-->", "", source, flags=re.S)
    t = re.sub(r"<ref\b[^<>]*/\s*>|<ref\b[^<>]*>.*?</ref\s*>|<(table|gallery|math)\b[^<>]*>.*?</\1\s*>", "", t, flags=re.S | re.I)
    t = _balanced(t, "{{", "}}", lambda _: "")
    t = _balanced(t, "{|", "|}", lambda _: "")

    def link(m: str) -> str:
        if media.match(m):
            return ""
        label = m[2:-2].rsplit("|", 1)[-1] if "|" in m else m[2:-2]
        return category.sub("", label)

    for _ in range(3):  # links in captions of links
        t = _balanced(t, "[[", "]]", link)
    t = re.sub(r"\[(?:https?|ftp)://[^\s\]]+\s*([^\]]*)\]", r"\1", t)
    t = re.sub(r"<[^<>]+>", "", t)
    t = re.sub(r"'{2,5}", "", t)
    t = re.sub(r"__[A-Z]+__", "", t)
    t = re.sub(r"^[*#:;]+\s*", "", t, flags=re.M)
    sections = re.split(r"(?m)^(?==+[^=\n].*?=+\s*$)", t)
    return "\n\n".join(s for s in (re.sub(r"(?m)^=+\s*(.*?)\s*=+\s*$", r"\1", x).strip() for x in sections) if s)


def wiki_extractor(language: str = "en") -> Callable[[Column], Column]:
    return _batched(lambda t: wiki_text(t, language), "string")


# --- LaTeX ---------------------------------------------------------------------------------------

# Commands that begin the text of a paper, and commands and environments that end it.
SECTIONS = set("part chapter section subsection subsubsection paragraph subparagraph".split())
ENDS = {"appendix", "bibliography"}
END_ENVIRONMENTS = {"references", "REFERENCES", "thebibliography"}


class _Latex:
    """Reads LaTeX in one pass, token by token: a command, an escaped character, a comment or a character."""

    def __init__(self, source: str):
        self.source, self.at = source, 0

    def __iter__(self):
        s, n = self.source, len(self.source)
        while self.at < n:
            begin, c = self.at, s[self.at]
            if c == "\\" and begin + 1 < n:
                end = begin + 1
                while end < n and s[end].isascii() and s[end].isalnum():
                    end += 1
                self.at = max(end, begin + 2)
                yield ("command" if end > begin + 1 else "text"), s[begin : self.at]
            elif c == "%":
                end = s.find("\n", begin)
                self.at = end = n if end < 0 else end
                # a comment that has its line to itself takes the line with it
                if end < n and (begin == 0 or s[begin - 1] == "\n"):
                    self.at = end + 1
                yield "comment", s[begin : self.at]
            else:
                end = begin + 1
                while end < n and s[end] not in "\\%":
                    end += 1
                self.at = end
                yield "text", s[begin:end]

    def argument(self, at: int) -> tuple[str | None, int]:
        """What stands in braces from ``at`` on, blanks skipped, and the place after it."""
        s = self.source
        while at < len(s) and s[at] in " \t\n":
            at += 1
        if at >= len(s) or s[at] != "{":
            return None, at
        depth, i = 0, at
        while i < len(s):
            if s[i] == "\\":
                i += 1
            elif s[i] == "{":
                depth += 1
            elif s[i] == "}":
                depth -= 1
                if depth == 0:
                    return s[at + 1 : i], i + 1
            i += 1
        return None, at


def latex_macros(source: str) -> dict[str, str]:
    """Macros without arguments: name to value."""
    out, reader = {}, _Latex(source)
    for kind, token in reader:
        name = None
        if kind == "command" and token in (r"\newcommand", r"\renewcommand", r"\providecommand"):
            at = reader.at + (source[reader.at : reader.at + 1] == "*")
            name, at = reader.argument(at)
        elif kind == "command" and token == r"\def":
            m = re.compile(r"\s*(\\[A-Za-z0-9]+)\s*(?=\{)").match(source, reader.at)
            name, at = (m[1], m.end()) if m else (None, 0)
        if name and re.fullmatch(r"\s*\\[A-Za-z0-9]+\s*", name):
            value, end = reader.argument(at)
            if value is not None:
                out[name.strip()] = value
                reader.at = end
    return out


def _latex_body(source: str, macros: dict[str, str]) -> str | None:
    """From the first section to the appendix or the references, without comments, macros replaced."""
    out, reader, began = [], _Latex(source), False
    for kind, token in reader:
        name = token[1:] if kind == "command" else None
        if not began:
            began = name in SECTIONS and re.compile(r"\*?(?:\[[^\]]*\])?\{").match(source, reader.at) is not None
            if not began:
                continue
        if kind == "comment":
            continue
        if name in ENDS or name == "begin" and reader.argument(reader.at)[0] in END_ENVIRONMENTS:
            break
        out.append(macros.get(token, token) if kind == "command" else token)
    return "".join(out).strip() if began else None


def latex_text(files: list[str] | str | None) -> str | None:
    """The body of a paper: from the first section on, without comments, bibliography and appendix, with
    macros that take no arguments replaced by their values.  An escaped percent sign begins no comment."""
    if files is None:
        return None
    files = [files] if isinstance(files, str) else files
    macros: dict[str, str] = {}
    for f in files:
        macros |= latex_macros(f)
    return "\n".join(b for f in files if (b := _latex_body(f, macros)) is not None) or None


def latex_extractor() -> Callable[[Column], Column]:
    return _batched(latex_text, "string")


# --- notebooks and other content ------------------------------------------------------------------


def notebook_text(source: str | None) -> str | None:
    """Cells of a notebook in order, separated by blank lines; None if it is none."""
    try:
        cells = json.loads(source or "")["cells"]
        texts = ["".join(c["source"]) if isinstance(c["source"], list) else c["source"] for c in cells]
    except (ValueError, TypeError, KeyError):
        return None
    return "\n\n".join(t.strip() for t in texts if t.strip())


def _is_notebook(content: bytes) -> bool:
    """Whether the whole content is a notebook's JSON, wherever its cells stand."""
    if b'"cells"' not in content or b'"nbformat' not in content:
        return False
    try:
        data = json.loads(content)
    except (ValueError, RecursionError):
        return False
    return isinstance(data, dict) and isinstance(data.get("cells"), list) and ("nbformat" in data or "nbformat_minor" in data)


def content_kind(content: bytes | None, mime: str | None = None, url: str | None = None) -> str:
    """notebook, html or text, by the content, the MIME type and the address."""
    begin = (content or b"").lstrip()[:512].lower()
    if (url or "").lower().split("?")[0].endswith(".ipynb") or (begin.startswith(b"{") and _is_notebook(content)):
        return "notebook"
    if "html" in (mime or "").lower() or begin.startswith((b"<!doctype html", b"<html")) or b"<html" in begin or b"<body" in begin:
        return "html"
    return "text"


def content_text(content: bytes | None, mime: str | None = None, url: str | None = None) -> tuple[str, str | None]:
    """(kind, text) of fetched content."""
    kind, text = content_kind(content, mime, url), decode_html(content)
    if text is None:
        return kind, None
    if kind == "notebook":
        return kind, notebook_text(text)
    return kind, "\n\n".join(b.text for b in html_blocks(text)) if kind == "html" else text


def extract_content(df: DataFrame, content_col: str, mime_col: str | None = None, url_col: str | None = None) -> DataFrame:
    """Add ``kind`` and ``text``; rows without text go."""

    def run(content: pd.Series, mime: pd.Series, url: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([content_text(*r) for r in zip(content, mime, url)], columns=["kind", "text"])

    run.__annotations__ = {"content": pd.Series, "mime": pd.Series, "url": pd.Series, "return": pd.DataFrame}
    none = F.lit(None).cast("string")
    made = deferred(run, "kind string, text string")(F.col(content_col), F.col(mime_col) if mime_col else none, F.col(url_col) if url_col else none)
    return df.withColumn("__x", made).withColumn("kind", F.col("__x.kind")).withColumn("text", F.col("__x.text")).drop("__x").where("text IS NOT NULL AND text <> ''")


# --- layout strings ------------------------------------------------------------------------------

# A page is a row of elements, each: place of one corner, text, place of the other corner, class.
_TAGS = re.compile(r"<(?:(x|y)_([0-9.]+)|class_([^<>]+)|[^<>]*)>")
FLOATING = ("Picture", "Caption")


def layout_elements(raw: str | None) -> list[dict]:
    """Elements (class, text, bbox) of a page's layout string; other text is one Text element."""
    raw = raw or ""
    out, numbers, words, at = [], [], [], 0
    for tag in _TAGS.finditer(raw):
        words.append(raw[at : tag.start()])
        at = tag.end()
        if tag[1]:
            try:
                numbers.append(float(tag[2]))
            except ValueError:
                continue
            if len(numbers) == 2:
                words = []  # text counts from the first corner on
        elif tag[3]:
            text = "".join(words).strip()
            if len(numbers) == 4 and (text or tag[3] in FLOATING[:1]):
                out.append({"class": tag[3], "text": text, "bbox": numbers})
            numbers, words = [], []
    if not out:
        bare = _TAGS.sub("", raw).strip()
        return [{"class": "Text", "text": bare, "bbox": None}] if bare else []
    return out


def reading_order(elements: list[dict]) -> list[dict]:
    """Pictures and captions are paired, each caption with the nearest free picture, and every pair goes
    after the other element that is nearest in height: the elements in order of a key."""
    middle = np.array([0.0 if e["bbox"] is None else (e["bbox"][1] + e["bbox"][3]) / 2 for e in elements])
    kinds = np.array([e["class"] for e in elements], object)
    anchors, pictures, captions = (np.nonzero(m)[0] for m in (~np.isin(kinds, FLOATING), kinds == FLOATING[0], kinds == FLOATING[1]))
    leader = np.arange(len(elements))  # of a caption its picture
    free = np.ones(len(pictures), bool)
    for c in captions:
        if free.any():
            near = np.where(free, np.abs(middle[pictures] - middle[c]), np.inf).argmin()
            leader[c], free[near] = pictures[near], False

    def key(i: int) -> tuple:
        if kinds[i] not in FLOATING:
            return (i, 0, 0.0, 0, 0)
        top = leader[i]
        after = int(anchors[np.abs(middle[anchors] - middle[top]).argmin()]) if len(anchors) else -1
        return (after, 1, float(middle[top]), kinds[top] != FLOATING[0], int(top), int(i != top))

    return [elements[i] for i in sorted(range(len(elements)), key=key)]


def parse_layout(reorder: bool = False) -> Callable[[Column], Column]:
    """A layout column to an array of elements."""

    def one(raw: str | None) -> list[dict]:
        found = layout_elements(raw)
        return [{"kind": e["class"], "text": e["text"], "bbox": e["bbox"]} for e in (reading_order(found) if reorder else found)]

    return _batched(one, "array<struct<kind:string,text:string,bbox:array<double>>>")
