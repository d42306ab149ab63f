"""Host-level quality rules.

Every document is measured over its whole text.  Failures of the soft rules are counted per host,
each host's rate is shrunk towards the rate of all hosts by an empirical beta prior (moments), and the
verdict on the host is joined back: a document is rejected if it fails the base limits, if it fails two
soft rules, or if it fails one in which its host's shrunken rate is above the limit.  A document that
fails no rule is always kept, whatever its host.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelwright.llm.common import tidy

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Soft rules: name -> condition of failure over the measures.
RULES = {
    "word_length": "n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words)",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: A host is bad in a rule that more than this share of its documents fail, after shrinking.
HOST_LIMIT = 0.05
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


def _pair_ids(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dense numbers of the pairs (left, right)."""
    return np.unique(left * (right.max() + 1) + right, return_inverse=True)[1]


def repeated_words(words: list, width: int = WINDOW) -> int:
    """Words inside a window of `width` words that occurs twice or more in the list."""
    n = len(words)
    if n <= width:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    if len(number) == n:
        return 0
    windows = ids[: n - width + 1]
    for k in range(1, width):
        windows = _pair_ids(windows, ids[k : n - width + 1 + k])
        if windows.max() + 1 == len(windows):  # all differ already
            return 0
    twice = np.flatnonzero(np.bincount(windows)[windows] > 1)
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + width, -1)
    return int((np.cumsum(edges)[:n] > 0).sum())


def text_measures(text: str | None) -> tuple[int, ...]:
    """The measures of one text; null counts as a text without words."""
    if not text:
        return (0,) * len(MEASURES)
    words = _SPACE.sub(" ", text).strip(" ").split(" ") if text.strip(" \t\n\v\f\r") else []
    lines = Counter(x for x in text.split("\n") if x.strip(" \t\n\v\f\r"))
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        sum(lines.values()) - len(lines),
        repeated_words(words),
        sum(lines.values()),
    )


def measure(docs: DataFrame, text: str = "text", into: str = "_quality") -> DataFrame:
    """All columns of `docs` and a struct of the measures (instead of a column of that name); no shuffle."""
    docs = docs.drop(into)
    measures = StructType([StructField(m, LongType()) for m in MEASURES])
    schema = StructType([*docs.schema.fields, StructField(into, measures)])

    def batches(parts):
        for batch in parts:
            rows = [text_measures(x) for x in batch.column(text).to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * len(MEASURES)
            struct = pa.StructArray.from_arrays(columns, names=list(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, into])

    return docs.mapInArrow(tidy(batches), schema)


def _of(condition: str, struct: str) -> Column:
    return F.expr(re.sub(r"\b(" + "|".join(MEASURES) + r")\b", rf"{struct}.\1", condition))


def host_key(host: str) -> Column:
    """Documents without a host share one."""
    return F.coalesce(F.col(host).cast("string"), F.lit(""))


def host_rates(measured: DataFrame, host: str = "source", limit: float = HOST_LIMIT, struct: str = "_quality") -> DataFrame:
    """Per host: `_host`, `n_docs`, and for each rule the shrunken failure rate and the verdict `bad_<rule>`.

    Rates p of hosts with n documents have the weighted variance s2; what sampling alone would give is
    taken off, and the rest fixes the size m of the beta prior: m = mu (1 - mu) / between - 1, within
    1 and 1e6.  The shrunken rate is (failures + mu m) / (n + m).
    """
    counts = measured.groupBy(host_key(host).alias("_host")).agg(
        F.count("*").alias("n_docs"), *(F.sum(_of(c, struct).cast("long")).alias(f"fail_{r}") for r, c in RULES.items())
    )
    totals = counts.agg(
        F.sum("n_docs").alias("n"),
        F.count("*").alias("hosts"),
        *(F.sum(f"fail_{r}").alias(f"f_{r}") for r in RULES),
        *(F.sum(F.col(f"fail_{r}") * F.col(f"fail_{r}") / F.col("n_docs")).alias(f"q_{r}") for r in RULES),
    ).first()  # one row
    out = counts
    for r in RULES:
        n = totals["n"] or 1
        mu = (totals[f"f_{r}"] or 0) / n
        noise = mu * (1 - mu) * totals["hosts"] / n
        between = (totals[f"q_{r}"] or 0) / n - mu * mu - noise
        size = 1e6 if between <= 0 else min(1e6, max(1.0, mu * (1 - mu) / between - 1))
        rate = (F.col(f"fail_{r}") + mu * size) / (F.col("n_docs") + size)
        out = out.withColumn(f"rate_{r}", rate).withColumn(f"bad_{r}", F.round(rate, 9) > limit)
    return out


def judged(measured: DataFrame, rates: DataFrame, host: str = "source", struct: str = "_quality") -> DataFrame:
    """The measured rows with `base_failed` and `kept`, under the struct column's name with `_verdict`.

    `rates` holds a row per host; join it from a written table, so that its measured size decides
    between a broadcast and a shuffled join, in which adaptive execution splits a hot host.
    """
    verdicts = rates.select("_host", *(F.col(f"bad_{r}").alias(f"_bad_{r}") for r in RULES))
    failed = [F.coalesce(_of(c, f"_row.{struct}"), F.lit(False)) for c in RULES.values()]
    base = _of(BASE, f"_row.{struct}")
    one_too_many = sum((f.cast("int") for f in failed[1:]), failed[0].cast("int")) >= 2
    by_host = F.lit(False)
    for f, r in zip(failed, RULES, strict=True):
        by_host = by_host | (f & F.coalesce(F.col(f"_bad_{r}"), F.lit(False)))
    verdict = F.struct(base.alias("base_failed"), (~base & ~one_too_many & ~by_host).alias("kept"))
    row = measured.drop(f"{struct}_verdict").select(F.struct("*").alias("_row"), host_key(host).alias("_host"))
    return row.join(verdicts, "_host", "left").select("_row.*", verdict.alias(f"{struct}_verdict"))
