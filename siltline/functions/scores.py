"""Document quality scores.

A ``Rule`` is a score, a Column of a text Column, and the condition under which a document is kept.
Scores are Catalyst expressions where the semantics allow, else Arrow-batched functions.  A score
that is undefined, for an empty text say, is null; a null score keeps nothing."""

from __future__ import annotations

import ast
import functools
import io
import operator
import re
import tokenize
from collections.abc import Callable
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import flat
from .expr import BLANK, SPACE_CLASS, VISIBLE, chars_in, count_of, deferred, joined_length, lines, lines_ending, paragraphs, ratio, strip, whole_words, word_total, words


@dataclass(frozen=True)
class Rule:
    """name, score(text) and keep(score)."""

    name: str
    score: Callable[[Column], Column]
    keep_if: Callable[[Column], Column]

    def keep(self, score: Column) -> Column:
        return F.coalesce(self.keep_if(score), F.lit(False))


def at_most(limit: float) -> Callable[[Column], Column]:
    return lambda s: s <= F.lit(limit)


def at_least(limit: float) -> Callable[[Column], Column]:
    return lambda s: s >= F.lit(limit)


def between(low: float, high: float) -> Callable[[Column], Column]:
    return lambda s: (s >= F.lit(low)) & (s <= F.lit(high))


# Fixed values.
ELLIPSES = ("...", "[...]", "…", "(...)", "[…]", "-»", "read more..", "read more")
BULLETS = "•‣⁃⁌⁍∙○●◘◦⦾⦿"
COMMON_WORDS = ("the", "be", "to", "of", "and", "that", "have", "with")
POLICY = (
    "terms of use",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "privacy overview",
    "use of cookies",
    "use cookies",
    "privacy & cookies policy",
    "privacy and cookies policy",
    "this website uses cookies to improve your experience while you navigate through the website. out of these cookies, the cookies that are categorized as necessary are stored on your browser as they are essential for the working of basic functionalities of the website. we also use third-party cookies that help us analyze and understand how you use this website. these cookies will be stored in your browser only with your consent. you also have the option to opt-out of these cookies. but opting out of some of these cookies may have an effect on your browsing experience.",
    "necessary cookies are absolutely essential for the website to function properly. this category only includes cookies that ensures basic functionalities and security features of the website. these cookies do not store any personal information.",
    "any cookies that may not be particularly necessary for the website to function and is used specifically to collect user personal data via analytics, ads, other embedded contents are termed as non-necessary cookies. it is mandatory to procure user consent prior to running these cookies on your website.",
    "this site uses cookies, including for analytics, personalization, and advertising purposes. for more information or to change your cookie settings, click here.",
    "if you continue to browse this site without changing your cookie settings, you agree to this use. acceptread more",
)
URL = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\(\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
ALPHANUMERIC = r"[a-zA-Z0-9\n?!,.]"

_or_one = lambda text, score: F.when(F.length(text) == 0, F.lit(1.0)).otherwise(score)


def non_alphanumeric(limit: float = 0.25) -> Rule:
    return Rule("non_alphanumeric", lambda t: _or_one(t, 1 - ratio(chars_in(t, ALPHANUMERIC), F.length(t))), at_most(limit))


def symbols_to_words(limit: float = 0.1) -> Rule:
    """Words that are an ellipsis or consist to more than a half of runs of #: such a word is # and
    single other characters in turn, with # at both ends."""
    marks = "|".join(re.escape(m) for m in ELLIPSES if " " not in m)
    return Rule("symbols_to_words", lambda t: ratio(whole_words(t, f"{marks}|#(?:[^#{SPACE_CLASS}]#)*"), word_total(t)), at_most(limit))


def numbers(limit: float = 0.15) -> Rule:
    return Rule("numbers", lambda t: _or_one(t, ratio(chars_in(t, r"\p{Nd}"), F.length(t))), at_most(limit))


def urls(limit: float = 0.2) -> Rule:
    return Rule("urls", lambda t: _or_one(t, ratio(joined_length(F.regexp_extract_all(t, F.lit(URL), 0)), F.length(t))), at_most(limit))


def bullets(limit: float = 0.9) -> Rule:
    return Rule("bullets", lambda t: ratio(count_of(t, f"(?<![^\\n])[{BLANK}]*[{BULLETS}]"), F.size(lines(t))), at_most(limit))


def white_space(limit: float = 0.25) -> Rule:
    return Rule("white_space", lambda t: _or_one(t, ratio(chars_in(t, r"[\t\n\r\u0008 ]"), F.length(t))), at_most(limit))


def parentheses(limit: float = 0.1) -> Rule:
    return Rule("parentheses", lambda t: _or_one(t, ratio(chars_in(t, r"[{}⟨⟩\[\]()]"), F.length(t))), at_most(limit))


def long_word(limit: int = 1000) -> Rule:
    return Rule("long_word", lambda t: F.array_max(F.transform(words(t), F.length)), at_most(limit))


def word_count(low: int = 50, high: int = 100_000) -> Rule:
    return Rule("word_count", lambda t: word_total(t), between(low, high))


def boilerplate(limit: float = 0.4) -> Rule:
    """1 with lorem ipsum, else the share of paragraphs with a policy phrase."""

    def score(t: Column) -> Column:
        low = F.lower(t)
        any_of = lambda x: functools.reduce(operator.or_, [x.contains(s) for s in POLICY])
        bad = F.filter(paragraphs(low), any_of)  # only texts with a phrase are taken apart
        return F.when(low.contains("lorem ipsum"), F.lit(1.0)).when(~any_of(low), F.lit(0.0)).otherwise(ratio(F.size(bad), F.size(paragraphs(t))))

    return Rule("boilerplate", score, at_most(limit))


def mean_word_length(low: float = 3, high: float = 10) -> Rule:
    return Rule("mean_word_length", lambda t: ratio(chars_in(t, VISIBLE), word_total(t)), between(low, high))


def punctuation(limit: float = 0.85) -> Rule:
    """Share of lines that do not end in an end mark."""
    return Rule("punctuation", lambda t: ratio(F.size(lines(t)) - lines_ending(t, "[.?!\"']"), F.size(lines(t))), at_most(limit))


def ellipsis(limit: float = 0.3) -> Rule:
    marks = "|".join(re.escape(m) for m in ELLIPSES)
    return Rule("ellipsis", lambda t: ratio(lines_ending(F.lower(t), marks), F.size(lines(t))), at_most(limit))


def common_english_words(least: int = 2, stop_early: bool = True) -> Rule:
    def score(t: Column) -> Column:
        n = whole_words(t, "|".join(COMMON_WORDS))
        return F.least(n, F.lit(least)) if stop_early and least >= 1 else n

    return Rule("common_english_words", score, at_least(least))


def words_without_alphabets(least: float = 0.8) -> Rule:
    """Share of words with an alphabetic character; the few without one are what is counted."""
    bare = f"[{VISIBLE}&&[^\\p{{IsAlphabetic}}]]+"
    return Rule("words_without_alphabets", lambda t: ratio(word_total(t) - whole_words(t, bare), word_total(t)), at_least(least))


def pornographic_urls() -> Rule:
    return Rule("pornographic_urls", lambda t: F.exists(F.regexp_extract_all(t, F.lit(URL), 0), lambda u: u.contains("porn")).cast("int"), lambda s: s != 1)


def substring(part: str, position: str) -> Rule:
    if position not in ("prefix", "suffix", "any"):
        raise ValueError(f"position must be prefix, suffix or any, not {position}")
    test = {"prefix": lambda t: t.startswith(part), "suffix": lambda t: t.endswith(part), "any": lambda t: t.contains(part)}[position]
    return Rule("substring", lambda t: test(t).cast("int"), lambda s: s == 1)


def repeated_lines(least: float = 0.7) -> Rule:
    return Rule("repeated_lines", lambda t: ratio(F.size(F.array_distinct(lines(t))), F.size(lines(t))), at_least(least))


def repeated_paragraphs(least: float = 0.7) -> Rule:
    return Rule("repeated_paragraphs", lambda t: ratio(F.size(F.array_distinct(paragraphs(t))), F.size(paragraphs(t))), at_least(least))


def repeated_lines_by_char(least: float = 0.8) -> Rule:
    return Rule("repeated_lines_by_char", lambda t: ratio(joined_length(F.array_distinct(lines(t))), joined_length(lines(t))), at_least(least))


def repeated_paragraphs_by_char(least: float = 0.8) -> Rule:
    return Rule("repeated_paragraphs_by_char", lambda t: ratio(joined_length(F.array_distinct(paragraphs(t))), joined_length(paragraphs(t))), at_least(least))





def top_ngram_share(text: str | None, n: int) -> float | None:
    return None if text is None else float(flat.Grams([text]).top_shares(n)[0])


def duplicate_ngram_share(text: str | None, n: int) -> float | None:
    return None if text is None else float(flat.Grams([text]).duplicate_shares(n)[0])


def _batched(fn: Callable[[str | None], object], kind: str) -> Callable[[Column], Column]:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(fn, na_action=None).astype("object")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return deferred(run, kind)


def repeating_top_ngrams(n: int = 2, limit: float = 0.2) -> Rule:
    return Rule(f"repeating_top_{n}grams", flat.gram_share("top", n), at_most(limit))


def repeating_duplicate_ngrams(n: int = 2, limit: float = 0.2) -> Rule:
    return Rule(f"repeating_duplicate_{n}grams", flat.gram_share("dup", n), at_most(limit))


def comment_share_python(code: str | None) -> float | None:
    """Share of characters in comments and docstrings; 0 if it does not parse."""
    if not code:
        return None
    try:
        tree = ast.parse(code)
        comments = [t.string.lstrip("#") for t in tokenize.generate_tokens(io.StringIO(code).readline) if t.type == tokenize.COMMENT]
    except (SyntaxError, ValueError, RecursionError, MemoryError, tokenize.TokenError):
        return 0.0
    docs = [ast.get_docstring(n, clean=False) or "" for n in ast.walk(tree) if isinstance(n, (ast.Module, ast.ClassDef, ast.FunctionDef, ast.AsyncFunctionDef))]
    return (sum(map(len, comments)) + sum(map(len, docs))) / len(code)


_COMMENTS = {
    "c": r"/\*(?P<a>.*?)\*/|//(?P<b>[^\n]*)|\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'",
    "sh": r"#(?P<a>[^\n]*)|\"(?:\\.|[^\"\\])*\"|'[^']*'",
    "html": r"<!--(?P<a>.*?)-->",
    "sql": r"--(?P<a>[^\n]*)|/\*(?P<b>.*?)\*/|'(?:''|[^'])*'",
}
# MIME types and the comment syntax of their languages.
_SYNTAX = {
    "text/x-c": "c", "text/x-c++": "c", "text/x-java-source": "c", "text/x-javascript": "c", "application/javascript": "c", "text/x-go": "c", "text/x-rust": "c", "text/x-csharp": "c",
    "text/x-shellscript": "sh", "text/x-ruby": "sh", "text/x-perl": "sh", "text/x-yaml": "sh", "text/x-python": "sh", "text/html": "html", "text/xml": "html", "application/xml": "html", "text/x-sql": "sql",
}


def comment_share(code: str | None, mime: str) -> float | None:
    """Share of characters in comments by the language's comment syntax; 9999 for other languages."""
    if not code:
        return None
    kind = _SYNTAX.get(mime, mime if mime in _COMMENTS else None)
    if kind is None:
        return 9999.0
    found = re.finditer(_COMMENTS[kind], code, re.S)
    return sum(len(g) for m in found for g in m.groupdict().values() if g) / len(code)


def python_comments(low: float = 0.01, high: float = 0.85) -> Rule:
    return Rule("python_comment_ratio", _batched(comment_share_python, "double"), between(low, high))


def general_comments(mime: str, low: float = 0.01, high: float = 0.85) -> Rule:
    return Rule("comment_ratio", _batched(lambda t: comment_share(t, mime), "double"), between(low, high))


def lines_of_code(low: int = 10, high: int = 20_000) -> Rule:
    return Rule("lines_of_code", lambda t: count_of(t, "\n") + 1, between(low, high))


Tokenizer = Callable[[list[str]], list[list[int]]]


def _token_counts(load: Callable[[], Tokenizer]):
    """A batched token counter; the tokenizer is loaded once per worker."""
    cell: list[Tokenizer] = []

    def run(texts: pd.Series) -> pd.Series:
        if not cell:
            cell.append(load())
        counts = iter(map(len, cell[0]([t for t in texts if t is not None])))
        return pd.Series([None if t is None else next(counts) for t in texts], dtype="Int64")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return deferred(run, "long")


def token_count(load: Callable[[], Tokenizer], low: int = 0, high: float = float("inf")) -> Rule:
    return Rule("token_count", _token_counts(load), between(low, high))


def tokenizer_fertility(load: Callable[[], Tokenizer], least: float = 2.5) -> Rule:
    """Characters per token, -1 for a text without tokens."""
    count = _token_counts(load)
    return Rule("tokenizer_fertility", lambda t: F.coalesce(ratio(F.length(t), count(t)), F.when(t.isNotNull(), F.lit(-1.0))), at_least(least))


def xml_header(prefix: int = 100) -> Rule:
    return Rule("xml_header", lambda t: F.substring(t, 1, prefix).contains("<?xml version=").cast("int"), lambda s: s != 1)


def alphabetic(least: float = 0.25) -> Rule:
    return Rule("alpha", lambda t: ratio(chars_in(t, r"\p{IsAlphabetic}"), F.length(t)), at_least(least))


class Markup(HTMLParser):
    """Reads any text: a section ``<![`` whose name HTML does not know is a comment up to the next ``>``, and
    a character reference of more digits than Python converts is one beyond the last character.  Tags that
    are a name only, which most are, are read at once, and positions are not counted."""

    def feed(self, data):
        super().feed(re.sub(r"(?<=&#)[0-9]{8,}", lambda m: n if len(n := m[0].lstrip("0") or "0") < 8 else "1114112", data))

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # no name, or an unknown one
            return self.parse_bogus_comment(i, report)

    def parse_starttag(self, i):
        m = _BARE_START.match(self.rawdata, i)
        if not m:
            return super().parse_starttag(i)
        tag = m[1].lower()
        self.handle_starttag(tag, [])
        if tag in self.CDATA_CONTENT_ELEMENTS:
            self.set_cdata_mode(tag)
        return m.end()

    def parse_endtag(self, i):
        m = _BARE_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if not m:
            return super().parse_endtag(i)
        self.handle_endtag(m[1].lower())
        return m.end()

    def updatepos(self, i, j):
        return j


_BARE_START, _BARE_END = re.compile(r"<([a-zA-Z][^\t\n\r\f />\x00]*)>"), re.compile(r"</([a-zA-Z][-.a-zA-Z0-9:_]*)>")


class _Visible(Markup):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def visible_share(html: str | None, least_chars: int = 100) -> float | None:
    """Share of characters that a reader sees; 0 if those are fewer than ``least_chars``."""
    if not html:
        return None
    p = _Visible()
    p.feed(html)
    p.close()
    n = len("".join(p.parts))
    return n / len(html) if n >= least_chars else 0.0


def html_boilerplate(least: float = 0.2, least_chars: int = 100) -> Rule:
    return Rule("html_boilerplate", _batched(lambda t: visible_share(t, least_chars), "double"), at_least(least))


def per_extension(df: DataFrame, limits: DataFrame, language: str, extension: str | None, text_col: str = "text", output_col: str = "per_extension") -> DataFrame:
    """1 if the source passes the limits of its (language, extension) in ``limits`` (columns language,
    extension, include, line_max, alphanum_min, alpha_min), else 0.  The limits are a small table of one
    row per pair, so their join is broadcast."""
    name = {"c#": "c-sharp", "f#": "f-sharp"}.get(language.lower(), language.lower().replace(" ", "-"))
    row = limits.where((F.col("language") == name) & (F.coalesce("extension", F.lit("")) == (extension or ""))).limit(1)
    row = row.select(F.struct("include", "line_max", "alphanum_min", "alpha_min").alias("__limits"))
    t, m = F.col(text_col), F.col("__limits")
    sizes = F.transform(F.split(t, "\n"), F.length)
    passes = (
        (F.coalesce(m.line_max, F.lit(0)) == 0) | ((F.array_max(sizes) <= m.line_max) & (ratio(F.length(t) + 1, F.size(sizes)) - 1 <= 100))
    ) & (F.coalesce(m.alphanum_min, F.lit(0.0)) <= F.coalesce(ratio(chars_in(t, ALPHANUMERIC), F.length(t)), F.lit(0.0))) & (F.coalesce(m.alpha_min, F.lit(0.0)) * F.length(t) <= count_of(t, r"\p{L}"))
    joined = df.join(F.broadcast(row), how="left")
    return joined.withColumn(output_col, F.when(t.isNotNull(), (F.coalesce(m.include, F.lit(False)) & passes).cast("int"))).drop("__limits")


def histogram(chars: set[str], least: float = 0.8) -> Rule:
    """1 if more than ``least`` of the characters are among ``chars``, the language's usual ones."""
    cls = "[" + "".join("\\u%04x" % ord(c) if ord(c) < 0x10000 else "\\x{%x}" % ord(c) for c in sorted(chars)) + "]"
    return Rule("histogram", lambda t: (ratio(count_of(strip(t), cls), F.length(t)) > least).cast("int"), lambda s: s == 1)


def usual_characters(df: DataFrame, text_col: str = "text", share: float = 0.95) -> set[str]:
    """The most frequent characters that make up ``share`` of trusted rows; an alphabet, so bounded."""
    chars = df.select(F.explode(F.split(strip(F.col(text_col)), "")).alias("c")).where("c <> ''").groupBy("c").count().orderBy(F.desc("count"), "c").collect()
    goal, got, out = share * sum(r["count"] for r in chars), 0, set()
    for r in chars:
        if got >= goal:
            break
        out.add(r["c"])
        got += r["count"]
    return out


def draw(key: Column, seed: int = 42) -> Column:
    """A number from 0 to below 1 that looks random and is the same for the same key, wherever it is drawn."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def quality_probability(score: Column, key: Column, alpha: float = 3.0, seed: int = 42) -> Column:
    """Stochastic keep of a model's quality score: a Lomax draw, by the document's key, above 1 - score."""
    return F.pow(1 - draw(key, seed), F.lit(-1.0 / alpha)) - 1 > 1 - score


def language_score(predict: Callable[[list[str]], list[tuple[float, str]]], least: float = 0.3) -> Rule:
    """A language model's score and code as a struct; kept at or above ``least``."""

    def run(texts: pd.Series) -> pd.DataFrame:
        found = iter(predict([t.replace("\n", " ") for t in texts if t is not None]))
        return pd.DataFrame([(None, None) if t is None else (lambda r: (r[0], r[1][-2:].upper()))(next(found)) for t in texts], columns=["score", "lang"])

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return Rule("language", deferred(run, "score double, lang string"), lambda s: s["score"] >= least)


def english_cascade() -> list[Rule]:
    """Order and thresholds of the shipped English cascade."""
    shares = [(2, 0.2), (3, 0.18), (4, 0.16)]
    copies = [(5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10)]
    return [
        non_alphanumeric(0.25), symbols_to_words(0.1), numbers(0.15), urls(0.2), white_space(0.25), parentheses(0.1), boilerplate(0.4), repeated_lines(0.7), repeated_paragraphs(0.7),
        repeated_lines_by_char(0.8), repeated_paragraphs_by_char(0.8), word_count(50, 100_000), punctuation(0.85), words_without_alphabets(0.8), common_english_words(2), mean_word_length(3, 10), long_word(1000), ellipsis(0.3),
        *[repeating_top_ngrams(n, x) for n, x in shares], *[repeating_duplicate_ngrams(n, x) for n, x in copies], bullets(0.9),
    ]


def other_cascade() -> list[Rule]:
    """The same for other languages: without the rules on ASCII letters and English words."""
    return [r for r in english_cascade() if r.name not in ("non_alphanumeric", "words_without_alphabets", "common_english_words")]


def code_cascade(load: Callable[[], Tokenizer]) -> list[Rule]:
    return [python_comments(0.001, 0.85), lines_of_code(5, 20_000), tokenizer_fertility(load, 2)]


def strip_punctuation(text: Column) -> Column:
    """Lower case without ASCII punctuation."""
    return F.regexp_replace(F.lower(text), r"[!-/:-@\[-`{-~]", "")
