"""What the operators once left out, against brute force."""

import numpy as np

from siltline.llm import canon, leaks, nearest, quality

from .test_problems import docs, pairs


def test_same_look_gives_every_pair_of_large_groups(spark):
    spellings = ["one text", "оne text", "one tехt", "one  text".replace("  ", " "), "ｏne text"]
    rows = [(i, spellings[i * i % 5]) for i in range(1, 16)] + [(20, spellings[3]), (21, "alone"), (22, "alone")]
    want = {(i, j) for i, x in rows for j, y in rows if i < j and x != y and canon.canonical(x) == canon.canonical(y)}
    for expand in (1, 3, 1000):
        found = [tuple(r) for r in canon.same_look(docs(spark, rows), expand=expand).collect()]
        assert set(found) == want and len(found) == len(want)


def test_same_look_of_many_variants(spark):
    rows = [(i, "".join("оo"[i >> b & 1] for b in range(6))) for i in range(64)]
    assert len(pairs(canon.same_look(docs(spark, rows), expand=10))) == 64 * 63 // 2


def test_nearest_recall_with_many_lists(spark):
    x = np.random.default_rng(3).normal(size=(1500, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embeddings array<float>")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    want = {(i, int(n)) for i, best in enumerate(np.argsort(-sims, axis=1)[:, :5]) for n in best}
    got = pairs(nearest.nearest(df, dim=8, list_size=15, train=1500).select("q", "n"))
    assert len(got & want) / len(want) >= 0.93


def test_short_items_are_found_verbatim(spark):
    texts = [[f"own{i}x{j}" for j in range(i % 9 + 1)] for i in range(90)]
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "item_id long, text string")
    rows = [(i, " ".join([f"a{i}b{j}" for j in range(40)] + w + [f"c{i}d{j}" for j in range(40)])) for i, w in enumerate(texts)]
    # words that stand in two texts, or not in a row, are no copy
    rows += [(500, texts[3][0] + " " + texts[3][1] + " x"), (501, " ".join(texts[3][2:])), (502, f"{texts[2][0]} {texts[2][1]} x {texts[2][2]}")]
    found = [tuple(r) for r in leaks.leaked(docs(spark, rows), items).select("doc_id", "item_id").collect()]
    assert sorted(found) == [(i, i) for i in range(90)]


def test_words_and_pairs_are_counted_over_all_documents(spark):
    texts = [f"the red boat and the blue boat and tail{i} 7" for i in range(40)] + ["the only", None]
    table = docs(spark, list(enumerate(texts))).repartition(3)
    v = quality.vocabulary_of(table.select("text").where("text IS NOT NULL"))
    assert list(v.ids) == ["the", "and", "boat", "blue", "red"]
    total = 40 * 10 + 2 + 1
    assert np.isclose(v.order[0, 1], np.log(1 / (81 * 80 / total + 1))) and np.isclose(v.order[2, 1], np.log(81 / (80 * 80 / total + 1)))
    unlabelled = spark.createDataFrame([], "doc_id long, quality string")
    got = {r["id"]: r["common_word_share"] for r in quality.quality(table, unlabelled).collect()}
    assert np.isclose(got[0], 0.8) and np.isclose(got[40], 0.5)
