"""Column builders for words, lines and paragraphs with the white space of Unicode text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: code points that count as white space in a text.
SPACE_CLASS = r"\u0009-\u000d\u001c-\u0020\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = f"[{SPACE_CLASS}]+"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, f"^{SPACES}|{SPACES}$", "")


# Patterns keep these builders free of lambdas, which Spark interprets row by row outside generated code.
# The class of what is not white space begins with the ASCII characters, which are settled by one comparison.
VISIBLE = f"[!-~[^{SPACE_CLASS}]]"
WORD = f"{VISIBLE}+"
LINE = f"[^\\n]*{VISIBLE}[^\\n]*"
BLANK = SPACE_CLASS.replace(r"\u0009-\u000d", r"\u0009\u000b-\u000d")  # white space within a line


def words(text: Column) -> Column:
    """Runs of anything but white space."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_total(text: Column) -> Column:
    """Number of words, without an array of them: each word with the white space around it becomes one
    character; what holds no word stays as it is and counts as none."""
    return F.when(text.rlike(VISIBLE), F.length(F.regexp_replace(text, f"[{SPACE_CLASS}]*{WORD}[{SPACE_CLASS}]*", "x"))).when(text.isNotNull(), F.lit(0))


def lines(text: Column) -> Column:
    """Lines that are not blank, as they are."""
    return F.regexp_extract_all(text, F.lit(LINE), F.lit(0))


def lines_ending(text: Column, marks: str) -> Column:
    """Lines whose last character that is not white space ends one of the marks (a pattern)."""
    return count_of(text, f"(?:{marks})[{BLANK}]*(?=\\n|\\z)")


def whole_words(text: Column, pattern: str) -> Column:
    """Words that match a pattern as a whole."""
    return count_of(text, f"(?<!{VISIBLE})(?:{pattern})(?!{VISIBLE})")


def joined_length(items: Column) -> Column:
    """Characters of an array of texts."""
    return F.length(F.array_join(items, ""))


def paragraphs(text: Column) -> Column:
    """Pieces between blank lines, empty ones included."""
    return F.split(text, "\n\n")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def total(items: Column, value) -> Column:
    """Sum of value(item) over an array."""
    return F.aggregate(items, F.lit(0).cast("long"), lambda acc, x: acc + value(x).cast("long"))


def chars_in(text: Column, char_class: str) -> Column:
    """Characters of a class, without an array of them."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{char_class}+", ""))


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def deferred(fn: Callable, kind: str, once: bool = False) -> Callable[..., Column]:
    """A pandas UDF that is made when it is applied, so that none needs a session at import.  With ``once``
    Spark is told that it is not deterministic: it then stays one evaluation where a condition on its result
    would else be moved below it and evaluate it again."""

    def make(*columns: Column) -> Column:
        udf = F.pandas_udf(fn, kind)
        return (udf.asNondeterministic() if once else udf)(*columns)

    return make
