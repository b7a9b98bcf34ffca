"""Models and services behind protocols, with deterministic stand-ins.

A model runs inside ``mapInPandas``, is made once for each Python worker's task and gets its
input in batches; a failed batch is tried again item by item, and a failed item gives null.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The labels of two layout detectors and the types they stand for.
DOCUMENT_LABELS = {
    "doc_title": "title",
    "paragraph_title": "title",
    "figure_title": "title",
    "text": "text",
    "abstract": "text",
    "content": "text",
    "reference": "text",
    "reference_content": "text",
    "footnote": "text",
    "aside_text": "text",
    "algorithm": "text",
    "image": "image",
    "chart": "image",
    "seal": "image",
    "formula": "formula",
    "formula_number": "formula",
    "table": "table",
    "header": "header",
    "footer": "footer",
    "number": "other",
}
PAGE_LABELS = {
    "title": "title",
    "plain text": "text",
    "figure": "image",
    "figure_caption": "caption",
    "table": "table",
    "table_caption": "caption",
    "table_footnote": "caption",
    "isolate_formula": "formula",
    "formula_caption": "caption",
    "abandon": "other",
}
PROVIDERS = ("anthropic", "groq", "openrouter", "gemini")


def canonical_type(label: Column, *tables: dict[str, str]) -> Column:
    """The type of a detector's label by its table (by both if none is given), "other" for a label that is not there."""
    known = {k: v for t in tables or (DOCUMENT_LABELS, PAGE_LABELS) for k, v in t.items()}
    kinds = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(kinds, label), F.lit("other"))


class Detector(Protocol):
    def __call__(self, pages: list[bytes]) -> list[list[tuple[str, float, tuple[float, float, float, float]]]]: ...


class Reader(Protocol):
    def __call__(self, pdf: bytes) -> list[dict[str, Any]]: ...


class UnknownProviderError(KeyError):
    """There is no such provider."""


def attempted(make: Callable[[], Callable[[list], list]], items: list, size: int) -> list[tuple]:
    """(result, error) of each item of a batch function in order; a batch that fails is done one by one, and what fails then has its error."""
    run, out = make(), []
    for at in range(0, len(items), size):
        some = items[at : at + size]
        try:
            out += [(x, None) for x in run(some)]
        except Exception:
            for one in some:
                try:
                    out += [(x, None) for x in run([one])]
                except Exception as e:
                    out.append((None, f"{type(e).__name__}: {e}"))
    return out


def batched(make: Callable[[], Callable[[list], list]], items: list, size: int) -> list:
    """The results alone; None for what has failed."""
    return [x for x, _ in attempted(make, items, size)]


def apply_model(df: DataFrame, column: str, make: Callable[[], Callable[[list], list]], name: str, kind: str, size: int = 16, error: str | None = None) -> DataFrame:
    """``df`` with a model's result for ``column`` as JSON read into ``kind``, and in the column ``error``, if one is named, why there is none."""
    schema = T.StructType([*df.schema.fields, T.StructField("_result", T.StringType()), T.StructField("_error", T.StringType())])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in it:
            got = attempted(lambda: model, pdf[column].tolist(), size)
            yield pdf.assign(_result=[None if g is None else json.dumps(g) for g, _ in got], _error=[e for _, e in got])

    out = df.mapInPandas(run, schema)
    out = out.withColumn(name, F.from_json("_result", f"struct<v:{kind}>")["v"] if kind != "string" else F.get_json_object("_result", "$.v")).drop("_result")
    return out.withColumnRenamed("_error", error) if error else out.drop("_error")


def stub_detector() -> Callable[[list], list]:
    """One text region over the page, for tests."""
    return lambda pages: [{"v": [{"label": "text", "score": 1.0, "x0": 0.0, "y0": 0.0, "x1": 595.0, "y1": 842.0}]} if p is not None else None for p in pages]


def stub_formula_ocr() -> Callable[[list], list]:
    return lambda crops: [{"v": f"x_{{{len(c)}}}"} if c else None for c in crops]


def stub_tutor(kind: str, provider: str = "anthropic") -> Callable[[list], list]:
    """Answers that depend on the prompt's length only. ``kind``: explain, grade or chat."""
    if provider not in PROVIDERS:
        raise UnknownProviderError(provider)
    if kind == "grade":
        return lambda prompts: [{"v": {"marks_awarded": 0, "max_marks": p.count("\n- "), "point_results": [], "feedback": f"{len(p)} characters"}} for p in prompts]
    return lambda prompts: [{"v": f"{kind}: {len(p)} characters"} for p in prompts]


def shape_batches(crops: DataFrame, shape: list[str], ordinal: str = "ord", size: int = 16, chunk: int = 10_000) -> DataFrame:
    """``crops`` with ``batch`` and ``place``: full batches of one shape in input order, by which a model's results go back to their crops.

    ``ordinal`` is an integer, one for each row. Rows are numbered inside chunks of the ordinal and moved up by the counts of the
    chunks before, so a shape that most crops have is worked on by many tasks; what one task sees of it is a count for each chunk.
    """
    own = crops.withColumn("_chunk", F.floor(F.col(ordinal) / chunk))
    before = Window.partitionBy(*shape).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = own.groupBy(*shape, "_chunk").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy(*shape, "_chunk").orderBy(ordinal)) - 1
    at = F.col("_at") + F.col("_before")
    ranked = own.withColumn("_at", inside).join(sums.select(*[F.col(k).alias(f"_s_{k}") for k in (*shape, "_chunk")], "_before"), reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in (*shape, "_chunk")]))
    return ranked.select(*crops.columns, F.floor(at / size).alias("batch"), (at % size).alias("place"))
