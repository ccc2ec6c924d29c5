"""Modifiers on chosen strings."""

import pytest
from pyspark.sql import functions as F

from siltline.functions import modifiers as M
from siltline.operators import score_filter as sf
from siltline.operators import split_join as sj

CASES = [
    ("boilerplate", M.remove_boilerplate, {"a\n\nb": "a\n\nb", "lorem ipsum x": "", "privacy policy\n\na": "a", "a\n\nuse cookies": "a", "a\n\nuse cookies\n\nb": "a\n\nuse cookies\n\nb", "use cookies": "use cookies", "use cookies\n\na\n\nuse cookies": "use cookies\n\na\n\nuse cookies"}),
    ("boilerplate_any", lambda t: M.remove_boilerplate(t, False), {"a\n\nuse cookies": "", "a": "a"}),
    ("lines", lambda t: M.remove_lines(t, ["x", ""]), {"a\nx\nb": "a\nb", "x": "", " x": " x"}),
    ("markdown", M.remove_markdown, {"**a** *b* _c_": "a b c", "[t](u)": "u", "a**b\nc**": "ab\nc", "a*b\nc*": "a*b\nc*"}),
    ("newlines", M.normalise_newlines, {"a\n\n\n\nb": "a\n\nb", "a\r\n\r\n\r\nb": "a\r\n\r\nb", "a\nb": "a\nb"}),
    ("quotes", M.remove_quotes, {'"abc"': "abc", '""': '""', '"a"\nb"': '"a"\nb"', '"a\nb"': "a\nb", 'a"': 'a"'}),
    ("slice_ints", lambda t: M.slice_text(t, 1, -1), {"abcd": "bc", "a": "", "": ""}),
    ("slice_strings", lambda t: M.slice_text(t, "<", ">", False, False), {"a< b >c>d": "b >c", "abc": ""}),
    ("urls", M.remove_urls, {"see https://a.b/c now": "see  now", "WWW.x.y z": " z"}),
    ("label", lambda t: M.label_for_training(t, "__label__a"), {"x\ny": "__label__a x y", "__label__b": "__label__a  b"}),
    ("knowledge", M.knowledge_list, {"Intro\n- a\n  b\nc": "a\nb\nc", "- a": "a", "x": ""}),
    ("unicode", M.unicode_reformatter(), {"Ã©tÃ©": "été", "a&amp;b": "a&b", "ﬁn": "fin", "Ｆ": "F", "a\x1b[31mb": "ab", "a\r\nb": "a\nb", "": ""}),
    ("control", M.remove_control_characters, {"a\x00b\x07": "ab"}),
]


@pytest.mark.parametrize("fn,cases", [c[1:] for c in CASES], ids=[c[0] for c in CASES])
def test_modifier(spark, fn, cases):
    df = spark.createDataFrame([(a, b) for a, b in cases.items()] + [(None, None)], "text string, want string")
    for r in df.withColumn("got", fn(F.col("text"))).collect():
        if r["text"] is not None:
            assert r["got"] == r["want"], r["text"]


def test_modify_arguments(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    assert sf.modify(df, lambda x, y: F.concat(x, y), ["x", "y"], "z").first()["z"] == "ab"
    with pytest.raises(ValueError):
        sf.modify(df, lambda x, y: F.concat(x, y), ["x", "y"])


def test_questions():
    assert M.question_pairs("t", "x") == "" and M.question_pairs("t", "") == ""
    out = M.question_pairs("t", "- Question: a\nAnswer: b\nQuestion: c", most=10)
    assert out.startswith("t\n\nQuestion:") and out == M.question_pairs("t", "- Question: a\nAnswer: b\nQuestion: c", most=10)


def test_token_chunks():
    count = lambda ps: [len(p.split()) for p in ps]
    assert M.token_chunks("a b\n\nc\n\n \n\nd e f g\n\nh", count, 3) == [(0, "a b\n\nc", 3), (1, "d e f g", 4), (2, "h", 1)]
    assert M.token_chunks(None, count) == []


def test_split_and_join(spark):
    df = spark.createDataFrame([(1, "a||b", "k"), (2, None, "l"), (3, "", "m")], "id int, text string, other string")
    parts = sj.split_documents(df, "|")
    assert sorted(tuple(r) for r in parts.collect() if r["id"] == 1) == [(1, "", "k", 1), (1, "a", "k", 0), (1, "b", "k", 2)]
    assert [tuple(r) for r in parts.collect() if r["id"] == 2] == [(2, None, "l", 0)]
    back = {r["id"]: r["text"] for r in sj.join_segments(parts, "id", "segment_id", "text", "|").collect()}
    assert back == {1: "a||b", 2: "", 3: ""}


def test_bounded_join(spark):
    rows = [(1, i, "x" * n) for i, n in enumerate([3, 3, 3, 10, 1])] + [(None, 0, "lost")]
    df = spark.createDataFrame(rows, "id int, seg int, text string").withColumn("n", F.length("text"))
    out = sorted((r["seg"], len(r["text"]), r["n"]) for r in sj.join_segments(df, "id", "seg", "text", "--", max_length=8, length_col="n").collect())
    assert out == [(0, 8, 8), (1, 3, 3), (2, 10, 10), (3, 1, 1)]


def test_merge_chunks(spark):
    rows = [("u", 1, "b", 2), ("u", 0, "a", 3), ("u", 1, "again", 9), ("u", 2, "  ", 1), ("v", 0, None, 1), ("w", 0, "long" * 10, 1), ("u", 3, "NONE", 1)]
    df = spark.createDataFrame(rows, "url string, chunk_id int, cleaned_text string, num_tokens int").coalesce(1)
    out = {r["url"]: (r["cleaned_text"], r["num_tokens"]) for r in sj.merge_chunks(df, ["url"], token_cols=["num_tokens"], raw_col="text", marker="NONE", most_chars=30).collect()}
    assert set(out) == {"u"} and out["u"][0] in ("a\nb", "a\nagain")
