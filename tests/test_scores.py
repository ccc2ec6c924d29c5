"""Scores against plain restatements, on chosen cases and on the test documents."""

import random
import re

import pytest
from pyspark.sql import functions as F

from siltline.functions import extract as X
from siltline.functions import flat
from siltline.functions import scores as S
from siltline.operators import score_filter as sf


def scored(spark, rule, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    out = df.withColumn("s", rule.score(F.col("text"))).withColumn("k", rule.keep(F.col("s"))).orderBy("i").collect()
    return [r["s"] for r in out], [r["k"] for r in out]


CASES = [
    (S.non_alphanumeric(0.25), ["abcd", "a b ", "", "####"], [0.0, 0.5, 1.0, 1.0], [True, False, False, False]),
    (S.symbols_to_words(0.1), ["# a b", "## a", "... a", ""], [1 / 3, 0.0, 0.5, None], [False, True, False, False]),
    (S.numbers(0.15), ["12ab", "abcd", "٣abc"], [0.5, 0.0, 0.25], [False, True, False]),
    (S.urls(0.2), ["see http://a.bc", "none", ""], [11 / 15, 0.0, 1.0], [False, True, False]),
    (S.bullets(0.9), ["• a\n  ‣ b", "a\n• b", "\n"], [1.0, 0.5, None], [False, True, False]),
    (S.white_space(0.25), ["a b c", "abcd e"], [0.4, 1 / 6], [False, True]),
    (S.parentheses(0.1), ["(a)", "a" * 30 + "()"], [2 / 3, 2 / 32], [False, True]),
    (S.long_word(3), ["abc de", "abcd", ""], [3, 4, None], [True, False, False]),
    (S.word_count(2, 3), ["one", "one two", "a b c d"], [1, 2, 4], [False, True, False]),
    (S.boilerplate(0.4), ["Lorem Ipsum", "x\n\nour privacy policy", "x", ""], [1.0, 0.5, 0.0, 0.0], [False, False, True, True]),
    (S.mean_word_length(3, 10), ["ab cd", "abc", ""], [2.0, 3.0, None], [False, True, False]),
    (S.punctuation(0.85), ["a.\nb", 'a"', "a\nb"], [0.5, 0.0, 1.0], [True, True, False]),
    (S.ellipsis(0.3), ["a...\nb", "a Read More", "a"], [0.5, 1.0, 0.0], [False, False, True]),
    (S.common_english_words(2), ["the be to", "the", "THE BE"], [2, 1, 0], [True, False, False]),
    (S.words_without_alphabets(0.8), ["a 1", "a b", ""], [0.5, 1.0, None], [False, True, False]),
    (S.pornographic_urls(), ["http://porn.x", "porn", ""], [1, 0, 0], [False, True, True]),
    (S.repeated_lines(0.7), ["a\na", "a\nb"], [0.5, 1.0], [False, True]),
    (S.repeated_paragraphs(0.7), ["a\n\na", "", "a"], [0.5, 1.0, 1.0], [False, True, True]),
    (S.repeated_lines_by_char(0.8), ["ab\nab\nc", "a"], [3 / 5, 1.0], [False, True]),
    (S.repeated_paragraphs_by_char(0.8), ["ab\n\nab", "a"], [0.5, 1.0], [False, True]),
    (S.repeating_top_ngrams(2, 0.2), ["a b a b", "a", "one two three four five six"], [6 / 7, 1.0, 7 / 27], [False, False, False]),
    (S.repeating_duplicate_ngrams(2, 0.2), ["a b a b", "a b c d", "x"], [3 / 7, 0.0, 1.0], [False, True, False]),
    (S.python_comments(0.01, 0.85), ["x = 1  # note", "def (", '"""doc"""'], [5 / 13, 0.0, 3 / 9], [True, False, True]),
    (S.general_comments("text/x-c"), ["int a; // b\n/* c */", 's = "// no";'], [5 / 19, 0.0], [True, False]),
    (S.lines_of_code(2, 3), ["a", "a\nb", "a\nb\nc\nd"], [1, 2, 4], [False, True, False]),
    (S.xml_header(), ['<?xml version="1.0"?>', "x"], [1, 0], [False, True]),
    (S.alphabetic(0.25), ["1234a", "ab", ""], [0.2, 1.0, None], [False, True, False]),
    (S.html_boilerplate(0.2, 3), ["<p>abc</p>", "<script>abc</script>", "<p>ab</p>"], [0.3, 0.0, 0.0], [True, False, False]),
    (S.substring("ab", "prefix"), ["abc", "cab"], [1, 0], [True, False]),
]


def test_html_of_any_text(spark):
    """Sections without a name HTML knows are comments to the next >; known ones, and references, stay as they were."""
    texts = ["<![*_]]60\n>abcd", "<![foo[x]]>abcd", "a<![b", "<![if x]>abcd<![endif]>", "<![CDATA[a>b]]>cd", "&#" + "9" * 5000 + ";abc", "&#" + "0" * 5000 + "65;bcd"]
    want = [4 / 15, 4 / 15, 5 / 5, 4 / 23, 2 / 17, 4 / 5006, 4 / 5008]
    assert scored(spark, S.html_boilerplate(0.2, 1), texts)[0] == [pytest.approx(w, abs=1e-9) for w in want]
    assert [b.text for b in X.html_blocks("<p>one</p><![_x]><p>two</p>")] == ["one", "two"]


@pytest.mark.parametrize("rule,texts,want,kept", CASES, ids=[c[0].name for c in CASES])
def test_rule(spark, rule, texts, want, kept):
    got, keep = scored(spark, rule, [*texts, None])
    for g, w in zip(got, want):
        assert (g is None) == (w is None) and (w is None or g == pytest.approx(w, abs=1e-9)), (rule.name, g, w)
    assert keep == [*kept, False if rule.name not in () else True] or keep[:-1] == kept


def test_bad_position():
    with pytest.raises(ValueError):
        S.substring("a", "middle")


def test_inverted_and_kept_are_all(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for rule in (S.word_count(), S.punctuation(), S.mean_word_length()):
        kept, rest = sf.score_filter(docs, rule), sf.score_filter(docs, rule, invert=True)
        assert kept.count() + rest.count() == docs.count()
        assert kept.join(rest, "doc_id").count() == 0


def test_chain_equals_single_steps(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rules = [S.word_count(), S.non_alphanumeric(), S.repeated_lines()]
    one = docs
    for r in rules:
        one = sf.score_filter(one, r)
    chained = sf.score_filter(docs, rules, score_cols=["a", None, "b"])
    assert {r["doc_id"] for r in one.select("doc_id").collect()} == {r["doc_id"] for r in chained.collect()}
    assert "a" in chained.columns and "b" in chained.columns and not any(c.startswith("__") for c in chained.columns)


def test_arguments(spark):
    df = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(ValueError):
        sf.score_filter(df, [S.word_count(), S.numbers()], score_cols="one")
    with pytest.raises(ValueError):
        sf.score(df, S.word_count(), "s", "missing")
    with pytest.raises(ValueError):
        sf.preserve_by_value(df, "text", "a", "like")
    with pytest.raises(ValueError):
        sf.add_id(df, "text")
    assert sf.add_id(df, "uid", "p", source_cols=["text"]).first()["uid"] == sf.add_id(df, "uid", "p", source_cols=["text"]).first()["uid"]


def test_ngram_scores_against_restatement(spark, data):
    texts = [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").where("text IS NOT NULL").collect()]
    for t in texts[:60]:
        ws = t.split()
        if len(ws) >= 3:
            grams = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)]
            top = max(dict.fromkeys(grams), key=grams.count)
            assert S.top_ngram_share(t, 3) == pytest.approx((len(t) - len(t.replace(top, ""))) / len(t))
    assert flat.gram_shares()  # builds without a session


def test_scores_of_a_batch_are_those_of_the_rules(spark, data):
    odd = ["", "   ", "\n\n", "a", "# a", "#a# #b#c# ##", "…", "read more..", "x read more \n y...\t\n• z\n  • k\n•", "http://porn.example/a%20b and https://x.y", "word " * 300, "lorem ipsum\n\nx", "terms of use\n\nprivacy policy\n\nz", "न म स् ते दुनिया", "a\xa0b\u2003c\x0bd\x0c", "the be to of THE that", "1 2 3 ४५", "((x)) [y] {z}"]
    d = spark.read.parquet(f"{data}/documents.parquet").select("text").unionByName(spark.createDataFrame([(t,) for t in odd], "text string")).where("text IS NOT NULL")
    rules = [r for r in S.english_cascade() if not r.name.startswith("repeating_")]
    assert flat.supported([r.name for r in rules])
    rows = d.select(*[r.score(F.col("text")).cast("double").alias(f"one_{r.name}") for r in rules], flat.heuristics([r.name for r in rules])(F.col("text")).alias("all")).collect()
    for r in rules:
        for row in rows:
            assert row[f"one_{r.name}"] == (None if row["all"][r.name] is None else pytest.approx(row["all"][r.name], abs=1e-9)), r.name


def test_grams_of_a_batch():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 2, 5, 9, 30, 200)] + ["x y z " * 50, "same words", "same words"]
    together = flat.Grams(texts)
    for n in (1, 2, 3, 5, 7):
        for i, t in enumerate(texts):
            ws = t.split()
            seen, covered = set(), set()
            for k in range(len(ws) - n + 1):
                g = tuple(ws[k : k + n])
                if g in seen:
                    covered |= {(j, k) for j in range(k, k + n)}
                seen.add(g)
            assert together.duplicate_shares(n)[i] == pytest.approx(flat.Grams([t]).duplicate_shares(n)[0]) and together.top_shares(n)[i] == pytest.approx(flat.Grams([t]).top_shares(n)[0])
            assert (together.duplicate_shares(n)[i] > 0) == (len(ws) < n or bool(covered))


def test_tokenizer_rules(spark):
    load = lambda: lambda ts: [t.split() for t in ts]
    got, keep = scored(spark, S.token_count(load, 2, 3), ["a b", "a", None])
    assert got == [2, 1, None] and keep == [True, False, False]
    got, _ = scored(spark, S.tokenizer_fertility(load, 2), ["ab cd", ""])
    assert got == [2.5, -1.0]


def test_per_extension(spark):
    limits = spark.createDataFrame([("c-sharp", "cs", True, 10, 0.5, None), ("ada", None, False, None, None, None)], "language string, extension string, include boolean, line_max int, alphanum_min double, alpha_min double")
    df = spark.createDataFrame([("short",), ("a line that is too long",), ("%%%%",), (None,)], "text string")
    assert [r["ok"] for r in S.per_extension(df, limits, "C#", "cs", output_col="ok").collect()] == [1, 0, 0, None]
    assert [r["ok"] for r in S.per_extension(df, limits, "Ada", None, output_col="ok").collect()] == [0, 0, 0, None]
    assert [r["ok"] for r in S.per_extension(df, limits, "Other", "x", output_col="ok").collect()] == [0, 0, 0, None]


def test_one_python_stage_in_the_cascade(spark, data):
    from siltline.plans.demo import heuristic_cascade

    df = heuristic_cascade(spark.read.parquet(f"{data}/documents.parquet"), S.english_cascade())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"ArrowEvalPython", plan)) == 1
