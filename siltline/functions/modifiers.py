"""Text modifiers: functions from a text Column to a text Column."""

from __future__ import annotations

import html
import random
import re
import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import SPACE_CLASS, deferred, paragraphs, strip
from .scores import POLICY, _batched


def remove_boilerplate(text: Column, only_at_ends: bool = True) -> Column:
    """Empty with lorem ipsum.  Paragraphs with a policy phrase go if they form one run that touches
    the first or the last paragraph and are not all; else the text stays.  Without ``only_at_ends`` any
    such paragraph empties the text."""
    paras = paragraphs(text)
    plain = F.transform(paras, lambda p: F.lower(strip(p)))
    hit = F.transform(plain, lambda p: F.greatest(*[p.contains(s) for s in POLICY]))
    at = F.filter(F.transform(hit, lambda h, i: F.when(h, i)), lambda i: i.isNotNull())
    n, first, last = F.size(at), F.array_min(at), F.array_max(at)
    at_end = (last - first + 1 == n) & ((first == 0) | (last == F.size(paras) - 1)) & (n < F.size(paras))
    cut = F.array_join(F.filter(paras, lambda p, i: ~F.array_contains(at, i)), "\n\n")
    some = F.when(at_end, cut).otherwise(text) if only_at_ends else F.lit("")
    return F.when(F.exists(plain, lambda p: p.contains("lorem ipsum")), F.lit("")).when(n == 0, text).otherwise(some)


def remove_lines(text: Column, patterns: Sequence[str]) -> Column:
    """Without the lines that equal a pattern."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda s: ~s.isin(*patterns)), "\n")


def remove_markdown(text: Column) -> Column:
    """Per line: bold, italic and underline marks go, a link leaves its address."""

    def plain(s: Column) -> Column:
        for pattern in (r"(?s)\*\*(.*?)\*\*", r"(?s)\*(.*?)\*", r"(?s)_(.*?)_"):
            s = F.regexp_replace(s, pattern, "$1")
        return F.regexp_replace(s, r"(?s)\[.*?\]\((.*?)\)", "$1")

    return F.array_join(F.transform(F.split(text, "\n"), plain), "\n")


def normalise_newlines(text: Column) -> Column:
    """At most two newlines in a row."""
    return F.regexp_replace(F.regexp_replace(text, r"\n{3,}", "\n\n"), r"(\r\n){3,}", "\r\n\r\n")


def remove_quotes(text: Column) -> Column:
    """Without quotation marks around the whole text."""
    bare = strip(text)
    first_line = F.split(bare, "\n")[0]
    quoted = (F.length(bare) > 2) & text.startswith('"') & text.endswith('"') & (~bare.contains("\n") | ~first_line.endswith('"'))
    return F.when(quoted, F.substring(text, F.lit(2), F.length(text) - 2)).otherwise(text)


def slice_text(text: Column, left: int | str = 0, right: int | str | None = None, include_left: bool = True, include_right: bool = True, trim: bool = True) -> Column:
    """From ``left`` to ``right``: positions as in a Python slice, or the first and the last occurrence
    of strings, which make the result empty if they are missing."""
    n = F.length(text)
    found = F.lit(True)
    if isinstance(left, str):
        at = F.instr(text, left)
        found, start = found & (at > 0), at - 1 + (0 if include_left else len(left))
    else:
        start = F.lit(left) if left >= 0 else F.greatest(F.lit(0), n + left)
    if isinstance(right, str):
        at = F.instr(F.reverse(text), right[::-1])
        found, end = found & (at > 0), n - at + 1 - (0 if include_right else len(right))
    else:
        end = n if right is None else F.least(n, F.lit(right)) if right >= 0 else F.greatest(F.lit(0), n + right)
    out = F.substring(text, (start + 1).cast("int"), F.greatest(F.lit(0), end - start).cast("int"))
    return F.when(found, strip(out) if trim else out).when(text.isNotNull(), F.lit(""))


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, f"(?i)(https?://[^{SPACE_CLASS}]+|www\\.[^{SPACE_CLASS}]+)", "")


def label_for_training(text: Column, label: str) -> Column:
    """One line with a label in front, as text classifiers read it."""
    return F.concat(F.lit(f"{label} "), F.regexp_replace(F.regexp_replace(text, "\n", " "), "__label__", " "))


_TERMINAL = re.compile(r"\x1b\[[0-9;]*[A-Za-z]|\x1b\][^\x07]*\x07?")
_CONTROL = {i: None for i in [*range(0, 9), 11, *range(14, 32), 127, 0xFEFF, *range(0xFFF9, 0xFFFD)]}
_CURLY = str.maketrans({"‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"'})
_LIGATURE = re.compile("[ﬀ-ﬆĲĳŉǱ-ǳǄ-ǌ]")
_WIDTH = re.compile("[！-～｡-ﾟ]+")


def reformat_unicode(text: str | None, unescape_html: bool = True, remove_terminal_escapes: bool = True, fix_encoding: bool = True, fix_latin_ligatures: bool = True, fix_character_width: bool = True, uncurl_quotes: bool = False, fix_line_breaks: bool = True, remove_control_chars: bool = True, normalization: str | None = None) -> str | None:
    """Repair text that was mis-decoded or escaped."""
    if not text:
        return text
    if unescape_html and "<" not in text:
        text = html.unescape(text)
    if remove_terminal_escapes:
        text = _TERMINAL.sub("", text)
    if fix_encoding:
        for codec in ("latin-1", "cp1252"):
            try:
                again = text.encode(codec).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
            text = again
            break
    if fix_latin_ligatures:
        text = _LIGATURE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
    if fix_character_width:
        text = _WIDTH.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
    if uncurl_quotes:
        text = text.translate(_CURLY)
    if fix_line_breaks:
        text = re.sub("\r\n|[\r\u0085  ]", "\n", text)
    if remove_control_chars:
        text = text.translate(_CONTROL)
    return unicodedata.normalize(normalization, text) if normalization else text


def unicode_reformatter(**options) -> Callable[[Column], Column]:
    return _batched(lambda t: reformat_unicode(t, **options), "string")


def remove_control_characters(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{Cc}", "")


def token_chunks(text: str | None, count: Callable[[list[str]], list[int]], most: int = 8000, separator: str = "\n\n") -> list[tuple[int, str, int]]:
    """(chunk number, text, tokens): paragraphs that are not blank, packed in order up to ``most``
    tokens; a longer paragraph is a chunk of its own."""
    paras = [p for p in (text or "").split(separator) if p.strip()]
    out: list[tuple[int, str, int]] = []
    held, size = [], 0
    for p, n in zip(paras, count(paras) if paras else []):
        if held and size + n > most:
            out.append((len(out), separator.join(held), size))
            held, size = [], 0
        held.append(p)
        size += n
    if held:
        out.append((len(out), separator.join(held), size))
    return out


def token_splitter(load: Callable[[], Callable[[list[str]], list[list[int]]]], most: int = 8000, separator: str = "\n\n") -> Callable[[Column], Column]:
    """An array of chunks (chunk_id, text, n_tokens) per text; explode it with ``inline``."""
    cell: list = []

    def run(texts: pd.Series) -> pd.Series:
        if not cell:
            cell.append(load())
        return texts.map(lambda t: [{"chunk_id": i, "text": c, "n_tokens": n} for i, c, n in token_chunks(t, lambda ps: list(map(len, cell[0](ps))), most, separator)], na_action=None)

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return deferred(run, "array<struct<chunk_id:int,text:string,n_tokens:int>>")


def question_pairs(text: str, generated: str, seed: int = 42, most: int = 10, tokens: int | None = None, prefix: str = "Here are the questions and answers based on the provided text:") -> str:
    """The text and a random choice of the generated question-answer pairs, empty if malformed."""
    rows = [r.strip() for r in (generated or "").split("\n") if r.strip()]
    rows = [r[2:].strip() if r.startswith("- ") else r for r in rows]
    rows = rows[1:] if rows and rows[0] == prefix else rows
    pairs: list[str] = []
    for r in rows:
        if r.startswith("Question:"):
            pairs.append(r)
        elif not pairs:
            return ""
        else:
            pairs[-1] = f"{pairs[-1]}\n{r}"
    if not pairs:
        return ""
    dice = random.Random(f"{seed}\n{text}")
    dice.shuffle(pairs)
    top = most if tokens is None else max(1, int(most * tokens / 150))
    return "\n\n".join([text, *pairs[: dice.randint(1, top)]])


def diverse_questions(seed: int = 42, most: int = 10) -> Callable[[Column, Column], Column]:
    def run(texts: pd.Series, generated: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else question_pairs(t, g, seed, most) for t, g in zip(texts, generated)], dtype="object")

    run.__annotations__ = {"texts": pd.Series, "generated": pd.Series, "return": pd.Series}
    return deferred(run, "string")


def knowledge_list(text: Column) -> Column:
    """Lines without list marks and indentation; a first line without a dash goes; null gives an empty text."""
    rows = F.split(F.coalesce(text, F.lit("")), "\n")
    kept = F.filter(rows, lambda s, i: (i > 0) | s.startswith("-"))
    return F.array_join(F.transform(kept, lambda s: F.when(s.startswith("  ") | s.startswith("- "), strip(F.substring(s, 3, 1_000_000_000))).otherwise(s)), "\n")
