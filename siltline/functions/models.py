"""Model-backed operators: a scorer that is loaded once per worker and fed in batches, and the rules
applied to what models return."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Scorer = Callable[[list], list]


def batched_scorer(load: Callable[[], Scorer], kind: str | T.DataType, batch: int = 256, by_length: bool = True) -> Callable[[Column], Column]:
    """A column function.  The model is loaded when a worker gets its first batch and stays for the
    partition; inputs of a batch are ordered by length, results come back in the order of the rows."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = None
        for part in parts:
            model = model or load()
            values = part.tolist()
            order = [i for i, v in enumerate(values) if v is not None]
            if by_length:
                order.sort(key=lambda i: len(values[i]))
            out: list = [None] * len(values)
            for b in range(0, len(order), batch):
                at = order[b : b + batch]
                for i, r in zip(at, model([values[i] for i in at])):
                    out[i] = r
            yield pd.Series(out, dtype="object")

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return lambda c: F.pandas_udf(run, kind)(c)


def tokenize(load: Callable[[], Callable[[list[str]], list[list[int]]]], most_chars: int | None = None, most_tokens: int | None = None) -> Callable[[Column], Column]:
    """Token ids of a text, cut to so many characters before and tokens after."""
    ids = batched_scorer(load, "array<int>")
    return lambda t: (lambda c: F.slice(c, 1, most_tokens) if most_tokens else c)(ids(F.substring(t, 1, most_chars) if most_chars else t))


def classify(df: DataFrame, probabilities: Column, labels: Sequence[str], label_col: str = "label", score_col: str | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Label of the greatest probability, the first of equals; optionally the scores and only some labels."""
    at = F.array_position("__p", F.array_max("__p"))
    out = df.withColumn("__p", probabilities).withColumn(label_col, F.element_at(F.array(*map(F.lit, labels)), at.cast("int")))
    out = out.withColumnRenamed("__p", score_col) if score_col else out.drop("__p")
    return out.where(F.col(label_col).isin(*keep)) if keep else out


def text_classifier(train: DataFrame, text_col: str, label_col: str, features: int = 1 << 16):
    """A pipeline of hashed words and logistic regression, fitted."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer, StringIndexer

    steps = [RegexTokenizer(inputCol=text_col, outputCol="__words", pattern=r"\W+"), HashingTF(inputCol="__words", outputCol="__features", numFeatures=features), StringIndexer(inputCol=label_col, outputCol="__y", handleInvalid="skip"), LogisticRegression(featuresCol="__features", labelCol="__y", maxIter=20)]
    return Pipeline(stages=steps).fit(train.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()))


def predict_labels(model, df: DataFrame, label_col: str = "predicted", probability_col: str | None = None) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    words, hashed, indexer, regression = model.stages  # the indexer reads the label, which new rows lack
    out = regression.transform(hashed.transform(words.transform(df)))
    out = classify(out, vector_to_array("probability"), indexer.labels, label_col, probability_col)
    return out.drop("__words", "__features", "rawPrediction", "probability", "prediction")


def hashed_embedding(dims: int = 64) -> Callable[[Column], Column]:
    """A stand-in for a model's embedding: counts of hashed words, at length 1; null for none."""

    def load() -> Scorer:
        import xxhash

        def embed(texts: list[str]) -> list:
            out = []
            for t in texts:
                v = [0.0] * dims
                for w in t.lower().split():
                    v[xxhash.xxh32_intdigest(w) % dims] += 1.0
                norm = sum(x * x for x in v) ** 0.5
                out.append([x / norm for x in v] if norm else None)
            return out

        return embed

    return batched_scorer(load, "array<float>")


def education_score(logit: Column) -> Column:
    """(score, int_score, label) of an educational-value model: clamped to 0..5, rounded half to even."""
    score = F.least(F.lit(5.0), F.greatest(F.lit(0.0), logit))
    return F.struct(score.alias("score"), F.bround(score, 0).cast("int").alias("int_score"), F.when(logit >= 2.5, "high_quality").otherwise("low_quality").alias("label"))


# Weights of the complexity of a prompt.
COMPLEXITY = {"creativity_scope": 0.35, "reasoning": 0.25, "constraint_ct": 0.15, "domain_knowledge": 0.15, "contextual_knowledge": 0.05, "number_of_few_shots": 0.05}


def prompt_complexity(heads: dict[str, Column]) -> Column:
    """Weighted sum of the heads, few-shots under 0.05 counting as none."""
    value = lambda k: F.when(heads[k] >= 0.05, heads[k]).otherwise(0.0) if k == "number_of_few_shots" else heads[k]
    return F.round(sum((value(k) * w for k, w in COMPLEXITY.items()), F.lit(0.0)), 5)


def safety_label(raw: Column) -> Column:
    """safe, the code on the second line of an unsafe answer, or unknown."""
    rows = F.split(F.trim(raw), "\n")
    first, code = F.lower(F.trim(rows[0])), F.trim(F.get(rows, F.lit(1)))
    return F.when(first == "safe", "safe").when((first == "unsafe") & (F.length(code) > 0), code).otherwise("unknown")


def threshold_keep(score: Column, least: float | None = None, most: float | None = None, missing: float | None = None) -> Column:
    """Within the limits; a missing score counts as ``missing`` or keeps nothing; None disables a limit."""
    s = F.coalesce(score, F.lit(missing)) if missing is not None else score
    kept = F.lit(True)
    if least is not None:
        kept = kept & (s >= least)
    if most is not None:
        kept = kept & (s < most)
    return F.coalesce(kept, F.lit(least is None and most is None))


def motion_keep(global_mean: Column, patch_min: Column, mean_least: float = 0.00098, patch_least: float = 1e-6) -> Column:
    """Clips with enough motion overall and in every patch; missing data scores -1 and goes."""
    return (F.coalesce(global_mean, F.lit(-1.0)) >= mean_least) & (F.coalesce(patch_min, F.lit(-1.0)) >= patch_least)


def prompt(template: str, **columns: Column) -> Column:
    """A template with {names} of columns filled in; null counts as empty."""
    import re

    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.coalesce(columns[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def generate(df: DataFrame, prompt_col: str, load: Callable[[], Scorer], output_col: str = "generated", batch: int = 32) -> DataFrame:
    """First response to each prompt, empty where there is none."""
    return df.withColumn(output_col, F.coalesce(batched_scorer(load, "string", batch, by_length=False)(F.col(prompt_col)), F.lit("")))


def clean_up(df: DataFrame, load: Callable[[], Scorer], tokens_col: str = "n_tokens", most_tokens: int = 4096, template: str = "{text}", text_col: str = "text", output_col: str = "cleaned_text", as_label: bool = False) -> DataFrame:
    """A model's rewriting of texts that leave it room: rows from 0.8 of its length on go."""
    rows = df.where(F.col(tokens_col) < 0.8 * most_tokens).sortWithinPartitions(tokens_col)
    made = generate(rows.withColumn("__prompt", prompt(template, **{text_col: F.col(text_col)})), "__prompt", load, "label" if as_label else output_col).drop("__prompt")
    return made.drop(text_col) if as_label else made


class Client:
    """Calls a function with retries and growing waits; at most ``at_once`` calls run together."""

    def __init__(self, call: Callable[[str], str], retries: int = 3, wait: float = 1.0, at_once: int = 5):
        self.call, self.retries, self.wait, self.at_once = call, retries, wait, at_once

    def one(self, text: str) -> str:
        for attempt in range(self.retries + 1):
            try:
                return self.call(text)
            except Exception:
                if attempt == self.retries:
                    raise
                time.sleep(self.wait * 2**attempt)
        raise AssertionError

    def __call__(self, texts: list[str]) -> list[str]:
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(self.at_once) as pool:
            return list(pool.map(self.one, texts))
