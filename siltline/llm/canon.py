"""One form for texts that look the same (problem 10), by DuckDB inside Arrow partitions.

Two strings get the same form exactly if they differ only in the width, composition or kind of
their characters and blanks.  Case, accents, wording and line breaks are kept.

Steps of the form, in order:

1. invisible characters (category Cf, variation selectors, grapheme joiner) go;
2. blanks of any kind (category Zs, tab) become a space; CR LF becomes LF;
3. full-width, half-width and font variants and Latin ligatures become plain letters;
4. look-alike letters become Latin ones, then accents are composed (NFC);
5. a word with a letter that only Cyrillic has is turned back to Cyrillic as a whole;
6. blanks at the end of a line go.

Step 4 forgets which script a look-alike had and step 5 depends on what step 4 left, so equal
looks always give equal forms.

Null stays null, an empty text stays empty, texts of any length are processed whole, repeated rows
stay repeated and an empty table gives an empty table.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import small, staged

# Letters of other scripts that look like Latin ones.
CYRILLIC = "аеорсухіјѕһԁԛԝӏАВЕКМНОРСТХУЅІЈԚԜЁёЇї"
LATIN_OF_CYRILLIC = "aeopcyxijshdqwlABEKMHOPCTXYSIJQWËëÏï"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧο"
LATIN_OF_GREEK = "ABEZHIKMNOPTYXo"
# Of these, the ones Russian uses, to turn a Cyrillic word back.
RUSSIAN = "аеорсухАВЕКМНОРСТХУЁё"
LATIN_OF_RUSSIAN = "aeopcyxABEKMHOPCTXYËë"
HYPHENS = "‐‑"
LIGATURES = range(0xFB00, 0xFB07)


@lru_cache(maxsize=1)
def tables() -> dict[str, object]:
    """Translation tables, built from the Unicode database by rule."""
    gone, one, many = [], {}, {}
    for cp in [*range(0x80, 0x3100), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0xE0100, 0xE01F0)]:
        ch, cat = chr(cp), unicodedata.category(chr(cp))
        tag = unicodedata.decomposition(ch).split(" ")[0]
        if cat == "Cf" or cp == 0x34F or 0xFE00 <= cp <= 0xFE0F or cp >= 0xE0100:
            gone.append(ch)
        elif cat == "Zs":
            one[ch] = " "
        elif tag in ("<wide>", "<narrow>", "<font>") or cp in LIGATURES:
            to = unicodedata.normalize("NFKC", ch)
            (one if len(to) == 1 else many)[ch] = to
    one |= dict.fromkeys(HYPHENS, "-") | {"\t": " "}
    alike = dict(zip(CYRILLIC, LATIN_OF_CYRILLIC)) | dict(zip(GREEK, LATIN_OF_GREEK))
    # a variant of a look-alike (a Greek letter in a font, say) goes all the way
    one = {k: alike.get(v, v) for k, v in one.items()} | alike
    return {"gone": gone, "one": one, "many": many}


def _class(chars: list[str]) -> str:
    """A regular-expression class of the characters, with ranges."""
    runs: list[list[int]] = []
    for cp in sorted(map(ord, chars)):
        if runs and runs[-1][1] == cp - 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return "[" + "".join(rf"\x{{{a:x}}}" + (rf"-\x{{{b:x}}}" if b > a else "") for a, b in runs) + "]"


ONLY_CYRILLIC = "бгдёжзийклмнптфцчшщъыьэюяБГДЖЗИЙЛПФЦЧШЩЪЫЬЭЮЯвт"
_CYR_ONLY = "".join(sorted(set(ONLY_CYRILLIC) - set(CYRILLIC)))


def canonical_sql(source: str, column: str) -> str:
    """A DuckDB subquery: ``source`` with the form of its text column as ``canon``.  The costly
    expressions stand in CASE branches, so only texts that need them pay for them."""
    t = tables()
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    plain = f"regexp_replace({column}, '{_class(t['gone'])}', '', 'g')"
    for ch, to in t["many"].items():
        plain = f"replace({plain}, {quote(ch)}, {quote(to)})" if ord(ch) in LIGATURES else plain
    plain = f"nfc_normalize(translate({plain}, {quote(''.join(t['one']))}, {quote(''.join(t['one'].values()))}))"
    back = (
        r"array_to_string(list_transform(regexp_extract_all(s, '[\p{L}\p{M}]+|[^\p{L}\p{M}]+'), "
        rf"lambda w: CASE WHEN regexp_matches(w, '[{_CYR_ONLY}]') THEN translate(w, {quote(LATIN_OF_RUSSIAN)}, {quote(RUSSIAN)}) ELSE w END), '')"
    )
    blank_end = "contains(f, chr(13)) OR contains(f, ' ' || chr(10)) OR suffix(f, ' ')"
    return rf"""(SELECT * EXCLUDE (odd, s, f), CASE WHEN {blank_end} THEN regexp_replace(f, '[ \r]+(\n|$)', '\1', 'g') ELSE f END AS canon
        FROM (SELECT *, CASE WHEN odd AND regexp_matches(s, '[{_CYR_ONLY}]') THEN {back} ELSE s END AS f
        FROM (SELECT *, CASE WHEN odd THEN {plain} WHEN contains({column}, chr(9)) THEN translate({column}, chr(9), ' ') ELSE {column} END AS s
        FROM (SELECT *, regexp_matches({column}, '{_odd_class()}') AS odd FROM {source}))))"""


@lru_cache(maxsize=1)
def _odd_class() -> str:
    """What step 1 to 4 may change; a text without these is only trimmed."""
    t = tables()
    moved = [chr(cp) for cp in [*range(0x80, 0x3100), *range(0xF900, 0xFB00)] if unicodedata.normalize("NFC", chr(cp)) != chr(cp) or unicodedata.category(chr(cp)) == "Mn"]
    moved += list(_CYR_ONLY)  # a Cyrillic word may hold Latin look-alikes only
    return _class([*t["gone"], *(c for c in t["one"] if c != "\t"), *t["many"], *moved])


@lru_cache(maxsize=1)
def _python_tables() -> tuple[np.ndarray, np.ndarray, list[tuple[str, str]], re.Pattern, re.Pattern, dict]:
    t = tables()
    to = np.arange(0x110000, dtype=np.uint32)
    for k, v in t["one"].items():
        to[ord(k)] = ord(v)
    to[[ord(c) for c in t["gone"]]] = 0
    odd = np.zeros(0x110000, bool)
    inner = re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), _odd_class())[1:-1]
    for m in re.finditer(r"(.)-(.)|(.)", inner, re.S):
        odd[ord(m[1] or m[3]) : ord(m[2] or m[3]) + 1] = True
    odd[0x3400:0xA000] = odd[0xAC00:0xD800] = False
    many = [(k, v) for k, v in t["many"].items() if ord(k) in LIGATURES]
    return to, odd, many, re.compile(f"[{_CYR_ONLY}]"), re.compile(r"[^\W\d_]+"), str.maketrans(LATIN_OF_RUSSIAN, RUSSIAN)


_TAIL = re.compile(r"[ \r]+(?=\n|\Z)")


def canonical(text: str) -> str:
    """The same form for one string in Python, for operators that have the text at hand."""
    if not text.isascii():
        to, odd, many, only, word, back = _python_tables()
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if odd[points].any():
            for k, v in many:
                if k in text:
                    text = text.replace(k, v)
                    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            points = to[points]
            text = unicodedata.normalize("NFC", points[points > 0].tobytes().decode("utf-32-le", "surrogatepass"))
            if only.search(text):
                text = word.sub(lambda m: m[0].translate(back) if only.search(m[0]) else m[0], text)
    if "\t" in text:
        text = text.replace("\t", " ")
    return _TAIL.sub("", text) if " \n" in text or text[-1:] in (" ", "\r") or "\r" in text else text


def _connect():
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
    con.execute("SET enable_progress_bar=false")
    return con


def in_duckdb(df: DataFrame, sql: str, schema: T.StructType | str) -> DataFrame:
    """Run ``sql`` over every Arrow batch of each partition, the batch being a view named ``batch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = None
        for batch in batches:
            con = con or _connect()
            view = con.from_arrow(pa.Table.from_batches([batch]))
            out = view.query("batch", sql).to_arrow_table()
            yield from out.combine_chunks().to_batches()

    return df.mapInArrow(run, schema)


def canonicalise(df: DataFrame, text_col: str = "text", output_col: str = "text_canonical") -> DataFrame:
    """Add ``output_col``: the text in the one form.  All other columns pass through, whatever
    their names; if ``output_col`` exists it is replaced."""
    keep = [f for f in df.schema.fields if f.name != output_col or f.name == text_col]
    inner = df.select(*[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(keep)])
    at = next(i for i, f in enumerate(keep) if f.name == text_col)
    schema = T.StructType([T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(keep)] + [T.StructField("canon", T.StringType(), True)])
    made = in_duckdb(inner, f"SELECT {', '.join(f'c{i}' for i in range(len(keep)))}, canon FROM {canonical_sql('batch', f'c{at}')}", schema)
    names = [f.name for f in keep]
    return made.toDF(*names, output_col) if output_col != text_col else made.drop(f"c{at}").toDF(*[n for n in names if n != text_col], text_col)


def looks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``look`` (128-bit hash of the form) and ``chars`` (hash of the characters) of every text
    that is neither null nor blank.  Repeated rows count once."""
    inner = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where(F.col("id").isNotNull() & F.col("t").isNotNull())
    sql = rf"SELECT id, md5(canon) AS look, md5(t) AS chars FROM {canonical_sql('batch', 't')} WHERE regexp_matches(canon, '\S')"
    return in_duckdb(inner, sql, T.StructType([inner.schema[0], T.StructField("look", T.StringType()), T.StructField("chars", T.StringType())])).dropDuplicates()


def same_look(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", expand: int = 1000) -> DataFrame:
    """Pairs (``lo``, ``hi``) of records whose texts look the same but differ in their characters.

    Every such pair is given.  Exact copies form a class first, so only classes of one look meet, and
    no pair of copies is ever made; the records of two classes are then joined.  Looks of more than
    ``expand`` classes and classes of more than ``expand`` records are spread over several keys of the
    joins.  Only the hashes are shuffled, never a text."""
    rows = staged(looks(df, id_col, text_col))
    mixed = rows.groupBy("look").agg(F.min("chars").alias("c0"), F.max("chars").alias("c1")).where("c0 <> c1").select("look")
    # staged before they are joined, so that a look or class with a great part of the rows is split
    member = staged(rows.join(small(staged(mixed), 500_000), "look", "left_semi"))
    classes = staged(member.groupBy("look", "chars").agg(F.count("*").alias("n")))
    parts = lambda c: F.ceil(F.col(c) / expand).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    part = lambda c, of: F.pmod(F.xxhash64(c), F.col(of)).cast("int")
    of_look = staged(classes.groupBy("look").agg(F.count("*").alias("v")).select("look", parts("v").alias("salts")))
    sized = classes.select("look", "chars", parts("n").alias("parts")).join(of_look, "look")
    left = sized.select("look", F.col("chars").alias("ca"), F.col("parts").alias("pa"), every("salts").alias("salt"))
    right = sized.select("look", F.col("chars").alias("cb"), F.col("parts").alias("pb"), part("chars", "salts").alias("salt"))
    met = left.join(right, ["look", "salt"]).where("ca < cb").select("ca", "pa", "cb", "pb")
    records = member.join(classes.select("chars", parts("n").alias("parts")), "chars").select("chars", "id", part("id", "parts").alias("part"))
    first = met.select("ca", "cb", "pb", every("pa").alias("part")).join(records.select(F.col("chars").alias("ca"), "part", F.col("id").alias("a")), ["ca", "part"])
    both = first.select("a", "cb", every("pb").alias("part")).join(records.select(F.col("chars").alias("cb"), "part", F.col("id").alias("b")), ["cb", "part"])
    return both.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
