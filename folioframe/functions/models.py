"""Hooks for what an expression cannot say: image analysis, text engines and models. Each takes its function as an argument, which is loaded
once a worker; without one, a plain deterministic stand-in is used, so that pipelines run where no model is installed."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def text_engine(load: Callable[[], Callable[[bytes], str]] | None = None):
    """Bytes of a page to its text."""

    @pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read = load() if load else lambda b: bytes(b).decode("utf-8", "replace")
        for s in batches:
            yield s.map(lambda b: None if b is None else read(b))  # noqa: B023

    return run


def scorer(load: Callable[[], Callable[[list[str]], list[float]]] | None = None):
    """Texts to a probability, in batches."""

    @pandas_udf(T.DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load() if load else lambda texts: [min(1.0, len(t.split()) / 500) for t in texts]
        for s in batches:
            yield pd.Series(model(s.fillna("").tolist()), dtype="float64")

    return run


def pair_scorer(load: Callable[[], Callable[[list[tuple[str, str]]], list[float]]] | None = None):
    """Whether one text goes on in another, for pairs that are rows already."""

    @pandas_udf(T.DoubleType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def plain(pairs):
            return [len(set(a.split()) & set(b.split())) / max(1, len(set(a.split()) | set(b.split()))) for a, b in pairs]

        model = load() if load else plain
        for a, b in batches:
            yield pd.Series(model(list(zip(a.fillna(""), b.fillna("")))), dtype="float64")

    return run


def image_facts(load: Callable[[], Callable[[bytes], tuple]] | None = None):
    """Bytes of an image to (size, dark share, blank): a real reader is given by load; the stand-in takes bytes as grey values."""

    @pandas_udf(T.StructType([T.StructField("size", T.LongType()), T.StructField("dark", T.DoubleType()), T.StructField("blank", T.BooleanType())]))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def plain(b):
            dark = sum(x < 64 for x in bytes(b)) / max(1, len(b))
            return len(b), round(dark, 6), dark <= 0.001

        read = load() if load else plain
        for s in batches:
            yield pd.DataFrame([read(b if b is not None else b"") for b in s], columns=["size", "dark", "blank"])

    return run


@pandas_udf(T.StringType())
def unicode_normal(s: pd.Series) -> pd.Series:
    """NFKC with blanks collapsed and digits masked."""
    return s.map(lambda t: None if t is None else "".join("#" if c.isdigit() else c for c in " ".join(unicodedata.normalize("NFKC", t).split())))


@pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp likeness; a text inside the other counts 0.93 at least; very unlike lengths 0."""

    def one(x, y):
        x, y = x or "", y or ""
        if not x or not y or min(len(x), len(y)) * 4 < max(len(x), len(y)):
            return 0.0
        r = difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()
        return max(r, 0.93) if x in y or y in x else r

    return pd.Series([round(one(x, y), 6) for x, y in zip(a, b)], dtype="float64")


def handwriting_band(p: Column) -> Column:
    """Bands of a classifier's answer."""
    return F.when(p >= 0.8, "handwritten").when(p <= 0.2, "printed").otherwise("unsure")


def quality(parts: list[Column], weights: list[float]) -> Column:
    """Sub-scores of an image to 0 to 100."""
    total = F.lit(0.0)
    for p, w in zip(parts, weights):
        total = total + F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)) * w
    return F.round(100 * total / sum(weights), 2)


@pandas_udf(T.ArrayType(T.StringType()))
def longest_matches(texts: pd.Series, terms: pd.Series) -> pd.Series:
    """Terms found in a text, longest first, no two of them overlapping."""

    def one(t, ts):
        t, used, out = (t or "").lower(), [], []
        for term in sorted(ts, key=lambda x: (-len(x), x)):
            at = t.find(term)
            while at >= 0:
                end = at + len(term)
                if all(end <= a or at >= b for a, b in used):
                    used.append((at, end))
                    out.append((at, term))
                at = t.find(term, at + 1)
        return [x for _, x in sorted(out)]

    return pd.Series([one(t, ts) for t, ts in zip(texts, terms)])
