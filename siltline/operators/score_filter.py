"""Scores, filters and modifiers as DataFrame transforms."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import Rule


def _many(value, n: int, what: str) -> list:
    """A scalar for all, or one for each."""
    if isinstance(value, (list, tuple)):
        if len(value) != n:
            raise ValueError(f"{n} rules need {n} of {what}, not {len(value)}")
        return list(value)
    return [value] * n


def require(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)}; there are {', '.join(df.columns)}")
    return df


def score(df: DataFrame, rules: Rule | Callable | Sequence, score_cols: str | Sequence[str], text_col: str | Sequence[str] = "text") -> DataFrame:
    """Add a column per rule or function of a column."""
    rules = list(rules) if isinstance(rules, (list, tuple)) else [rules]
    names = [score_cols] if isinstance(score_cols, str) else list(score_cols)
    if len(names) != len(rules):
        raise ValueError("every rule needs its own score column")
    texts = _many(text_col, len(rules), "text_col")
    require(df, *texts)
    return df.withColumns({n: (r.score if isinstance(r, Rule) else r)(F.col(t)) for n, r, t in zip(names, rules, texts)})


def filter_rows(df: DataFrame, conditions: Rule | Callable | Sequence, columns: str | Sequence[str], invert: bool = False) -> DataFrame:
    """Keep rows whose column meets the condition; null meets none, and inverting keeps the others."""
    conditions = list(conditions) if isinstance(conditions, (list, tuple)) else [conditions]
    for c, name in zip(conditions, _many(columns, len(conditions), "columns")):
        kept = F.coalesce((c.keep_if if isinstance(c, Rule) else c)(F.col(name)), F.lit(False))
        df = df.where(~kept if invert else kept)
    return df


def score_filter(df: DataFrame, rules: Rule | Sequence[Rule], text_col: str | Sequence[str] = "text", score_cols: str | Sequence[str | None] | None = None, invert: bool = False) -> DataFrame:
    """Score and filter, one rule after the other; a score without a column name is not kept."""
    rules = list(rules) if isinstance(rules, (list, tuple)) else [rules]
    if isinstance(score_cols, str) and len(rules) > 1:
        raise ValueError("every rule needs its own score column")
    for i, (r, t, name) in enumerate(zip(rules, _many(text_col, len(rules), "text_col"), _many(score_cols, len(rules), "score_cols"))):
        column = name or f"__score_{i}"
        df = require(df, t).withColumn(column, r.score(F.col(t)))
        kept = r.keep(F.col(column))
        df = df.where(~kept if invert else kept)
        if name is None:
            df = df.drop(column)
    return df


def modify(df: DataFrame, modifiers: Callable | Sequence[Callable], input_cols: str | Sequence = "text", output_cols: str | Sequence | None = None) -> DataFrame:
    """Apply functions of columns in order, in place or into a new column; a function of several
    columns takes them as arguments and needs an output."""
    modifiers = list(modifiers) if isinstance(modifiers, (list, tuple)) else [modifiers]
    many = isinstance(input_cols, (list, tuple)) and len(modifiers) == 1 and all(isinstance(c, str) for c in input_cols)
    inputs = [list(input_cols)] if many else _many(input_cols, len(modifiers), "input_cols")
    for fn, cols, out in zip(modifiers, inputs, _many(output_cols, len(modifiers), "output_cols")):
        cols = [cols] if isinstance(cols, str) else list(cols)
        if len(cols) > 1 and out is None:
            raise ValueError("a modifier of several columns needs an output column")
        df = require(df, *cols).withColumn(out or cols[0], fn(*map(F.col, cols)))
    return df


COMPARE = {"lt": operator.lt, "le": operator.le, "eq": operator.eq, "ne": operator.ne, "ge": operator.ge, "gt": operator.gt}


def preserve_by_value(df: DataFrame, column: str, target, comparison: str = "eq") -> DataFrame:
    """Keep rows whose column compares to the target as wanted."""
    if comparison not in COMPARE:
        raise ValueError(f"comparison must be one of {', '.join(COMPARE)}")
    return require(df, column).where(COMPARE[comparison](F.col(column), F.lit(target)))


def keep_labels(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    return require(df, column).where(F.col(column).isin(*labels))


def add_id(df: DataFrame, id_col: str, prefix: str | None = None, overwrite: bool = False, source_cols: Sequence[str] | None = None) -> DataFrame:
    """A text id per row.  With ``source_cols`` it is the hash of these columns and the same on every
    run; else partition and row number, which is unique in this run."""
    if id_col in df.columns and not overwrite:
        raise ValueError(f"column {id_col} is there already")
    made: Column = F.lower(F.hex(F.xxhash64(*source_cols))) if source_cols else F.monotonically_increasing_id().cast("string")
    return df.withColumn(id_col, F.concat_ws("_", F.lit(prefix), made) if prefix else made)


def center_crop(text: Column, chars: int = 10_000) -> Column:
    """The middle of a text, ``chars`` to each side."""
    middle = F.floor(F.length(text) / 2).cast("int")
    start = F.greatest(F.lit(0), middle - chars)
    return F.substring(text, start + 1, F.least(middle + chars, F.length(text)) - start)


def head(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)


def select_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of the columns that exist; none is an error."""
    found = [c for c in columns if c in df.columns]
    if not found:
        raise ValueError("none of the columns exists")
    return df.select(*found)
