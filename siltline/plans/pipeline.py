"""Pipelines: a registry of transforms, chains of them, and chains from a specification."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Transform = Callable[[DataFrame], DataFrame]
_STAGES: dict[str, Callable[..., Any]] = {}


def stage(name: str | None = None) -> Callable[[Callable], Callable]:
    """Register a function whose first argument is a DataFrame; called without one it gives a transform."""

    def put(f: Callable) -> Callable:
        key = name or f.__name__
        if key in _STAGES:
            raise ValueError(f"there is a stage {key} already")
        _STAGES[key] = f
        return f

    return put


def stage_named(name: str) -> Callable:
    if name not in _STAGES:
        raise KeyError(f"no stage {name}; there are {', '.join(sorted(_STAGES))}")
    return _STAGES[name]


@dataclass(frozen=True)
class Step:
    """A named transform with its options; ``with_`` gives a changed copy."""

    name: str
    run: Callable[..., DataFrame]
    options: dict[str, Any] = field(default_factory=dict)
    needs: tuple[str, ...] = ()
    gives: tuple[str, ...] = ()

    def with_(self, name: str | None = None, **options: Any) -> Step:
        return Step(name or self.name, self.run, self.options | options, self.needs, self.gives)

    def __call__(self, df: DataFrame) -> DataFrame:
        missing = [c for c in self.needs if c not in df.columns]
        if missing:
            raise ValueError(f"stage {self.name} needs the columns {', '.join(missing)}")
        out = self.run(df, **self.options)
        missing = [c for c in self.gives if c not in out.columns]
        if missing:
            raise ValueError(f"stage {self.name} did not give the columns {', '.join(missing)}")
        return out


class Pipeline:
    """A chain of steps.  It only builds a plan: Spark runs it as a whole when the result is used."""

    def __init__(self, name: str, steps: Sequence[Step | Transform] = ()):
        self.name, self.steps = name, [self._step(s) for s in steps]

    @staticmethod
    def _step(s: Step | Transform) -> Step:
        return s if isinstance(s, Step) else Step(getattr(s, "__name__", "step"), s)

    def add(self, s: Step | Transform | Pipeline) -> Pipeline:
        """A step, or the steps of another pipeline in its place."""
        self.steps += s.steps if isinstance(s, Pipeline) else [self._step(s)]
        return self

    def with_(self, changes: dict[str, dict[str, Any]]) -> Pipeline:
        """A copy with other options for steps by name."""
        unknown = set(changes) - {s.name for s in self.steps}
        if unknown:
            raise KeyError(f"no steps {', '.join(sorted(unknown))}")
        return Pipeline(self.name, [s.with_(**changes.get(s.name, {})) for s in self.steps])

    def run(self, df: DataFrame) -> DataFrame:
        if not self.steps:
            raise ValueError("the pipeline has no steps")
        for s in self.steps:
            df = s(df)
        return df

    __call__ = run

    def describe(self) -> str:
        return "\n".join([self.name, *(f"{i}. {s.name} {s.options or ''}".rstrip() for i, s in enumerate(self.steps, 1))])

    def run_measured(self, df: DataFrame) -> tuple[DataFrame, dict[str, Any]]:
        """The result and, once it has been computed, the rows each step let through (by observation,
        without another pass)."""
        from pyspark.sql import Observation
        from pyspark.sql import functions as F

        seen = {}
        for i, s in enumerate(self.steps):
            seen[s.name] = Observation(f"{i}-{s.name}")
            df = s(df).observe(seen[s.name], F.count(F.lit(1)).alias("rows"))
        return df, seen


def read_spec(spec: dict | str) -> dict:
    """A specification as a dictionary, from JSON or, where a reader of it is installed, YAML text."""
    if isinstance(spec, dict):
        return spec
    try:
        return json.loads(spec)
    except json.JSONDecodeError:
        try:
            import yaml
        except ImportError:
            raise ValueError("the specification is no JSON, and no reader of YAML is installed") from None
        return yaml.safe_load(spec)


def from_spec(spec: dict | str) -> Pipeline:
    """A pipeline from a dictionary, JSON or YAML text: ``{"name": ..., "stages": [{"stage": name, option: value}]}``.
    A stage is a registered name or module:function of this package; ``${variable}`` is looked up among the
    other keys of the specification.  Rules are given as {"rule": name, option: value}."""
    spec = read_spec(spec)
    if "stages" not in spec or "workflow" in spec:
        raise ValueError("a specification has stages and no workflow")
    from ..functions import scores

    def value(v: Any) -> Any:
        if isinstance(v, str) and v.startswith("${") and v.endswith("}"):
            return value(spec[v[2:-1]])
        if isinstance(v, dict) and "rule" in v:
            return getattr(scores, v["rule"])(**{k: value(x) for k, x in v.items() if k != "rule"})
        return [value(x) for x in v] if isinstance(v, list) else v

    steps = []
    for s in spec["stages"]:
        name = s["stage"]
        if ":" in name:
            module, _, attribute = name.partition(":")
            run = getattr(importlib.import_module(f"siltline.{module}"), attribute)
        else:
            run = stage_named(name)
        steps.append(Step(name, run, {k: value(v) for k, v in s.items() if k != "stage"}))
    return Pipeline(spec.get("name", "pipeline"), steps)


def run_spec(spark: SparkSession, spec: dict | str) -> DataFrame | None:
    """A whole specification: ``input`` (path, format), stages, ``output`` (path, format, mode)."""
    from ..sources import files, sinks

    spec = read_spec(spec)
    read = {"jsonl": files.read_jsonl, "parquet": files.read_parquet}[spec["input"].get("format", "jsonl")]
    df = from_spec({k: v for k, v in spec.items() if k not in ("input", "output")}).run(read(spark, spec["input"]["path"], spec["input"].get("fields")))
    if "output" not in spec:
        return df
    out = spec["output"]
    {"jsonl": sinks.write_jsonl, "parquet": sinks.write_parquet}[out.get("format", "jsonl")](df, out["path"], out.get("mode", "ignore"), out.get("fields"))
    return None


def _register() -> None:
    from ..operators import dedup, interleaved, media, score_filter, split_join, windows

    for f in (score_filter.score, score_filter.filter_rows, score_filter.score_filter, score_filter.modify, score_filter.preserve_by_value, score_filter.keep_labels, score_filter.add_id, score_filter.select_present, split_join.split_documents, split_join.join_segments, split_join.merge_chunks, dedup.remove, dedup.exact_duplicates, dedup.fuzzy_duplicates, interleaved.image_to_text_ratio, windows.conversation_windows, windows.filter_overlaps, media.aspect_ratio_filter, media.blur_filter, media.code_filter, media.clip_stats, media.to_documents):
        stage()(f)


_register()
