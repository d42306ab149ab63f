"""How filters overlap, by sorted posting lists.

Rows are numbered in order of part and id.  A posting list holds the numbers of the rows of one part that
fail one filter, in ascending order, in pieces of `RANGE` numbers; marks (labels such as good or toxic)
have lists of the same kind.  For every filter f and every set S of other filters, a task merges the lists of
S to their union and takes it from the list of f; what is left is what f removes after S, whatever the
order within S.  The lists of a piece are merged by galloping: a run of numbers looks for its window in the
longer list by doubling steps and then for its places inside the window.  Sizes of the pieces are summed by
part, and every order of the filters is read off them.

Pieces have at most `RANGE` rows of one part, so a part with a third of all rows is as many pieces as it takes.

Null and repeated ids are rows like others.  A null part is the part named by the empty string.  A null verdict is no
failure, a null mark none.  A table without rows has no parts.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import cut, numbered

RANGE = 1 << 15
RUN = 64
#: Characters that filter D looks for.
SYMBOLS = b"[#$%&*|]"
_UPPER = bytes(range(65, 91))


def gallop(needles: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """Which of the sorted needles the sorted hay holds.

    Needles go in runs.  From where the last run ended, steps double until they pass the run's last
    needle; only that window is searched.
    """
    found, at = np.zeros(len(needles), bool), 0
    for a in range(0, len(needles), RUN):
        run = needles[a : a + RUN]
        step = 1
        while at + step < len(hay) and hay[at + step] <= run[-1]:
            step *= 2
        window = hay[at : at + step + 1]
        if not len(window):
            break
        places = np.searchsorted(window, run)
        inside = np.minimum(places, len(window) - 1)
        found[a : a + RUN] = window[inside] == run
        at += int(places[-1])
    return found


def minus(numbers: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """The sorted numbers that are not among the sorted numbers taken."""
    return numbers[~gallop(numbers, taken)]


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Sorted distinct numbers of sorted lists: the longest takes in what the others have beyond it."""
    out = np.zeros(0, np.int64)
    for numbers in sorted(lists, key=len, reverse=True):
        new = minus(numbers, out)
        out = np.insert(out, np.searchsorted(out, new), new) if len(out) else new
    return out


def removed_after(lists: list[np.ndarray], marks: list[np.ndarray]) -> list[tuple]:
    """(filter, set of earlier filters, removed, and of these every mark's) of one piece of one part."""
    rows = []
    for earlier in range(1 << len(lists)):
        taken = union([x for f, x in enumerate(lists) if earlier >> f & 1])
        for f, numbers in enumerate(lists):
            if not earlier >> f & 1:
                left = minus(numbers, taken)
                rows.append((f, earlier, len(left), *(int(gallop(left, m).sum()) for m in marks)))
    return rows


def postings(rows: DataFrame, part: str, id: str, fails: dict[str, Column], marks: dict[str, Column]) -> DataFrame:
    """Per part and piece: part, piece, rows, and a sorted list of row numbers of every filter and mark."""
    lists = [*fails.values(), *marks.values()]
    bits = sum((F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(lists)), F.lit(0))
    narrow = rows.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(id).alias("_id"), bits.alias("_bits"))
    placed, _ = numbered(narrow, "part", "_id", "_bits")
    bit = lambda k: F.col("_bits").bitwiseAND(1 << k) > 0
    held = [F.sort_array(F.collect_list(F.when(bit(k), F.col("row_no")))).alias(f"_{k}") for k in range(len(lists))]
    pieces = placed.groupBy("part", F.expr(f"row_no div {RANGE}").alias("piece"))
    return pieces.agg(F.count("*").alias("rows"), *held)


def sizes(lists: DataFrame, filters: int, marks: int) -> DataFrame:
    """Per part, filter and set of earlier filters (a bit each): removed, and the marks' m0, m1, ... among them; filter -1: all rows."""
    names = ["filter", "earlier", "removed", *(f"m{k}" for k in range(marks))]

    def merged(parts):
        for batch in parts:
            out = []
            columns = [batch.column(f"_{k}") for k in range(filters + marks)]
            for i, (part, n) in enumerate(zip(batch.column("part").to_pylist(), batch.column("rows").to_pylist(), strict=True)):
                held = [c[i].values.to_numpy(zero_copy_only=False) for c in columns]
                found = removed_after(held[:filters], held[filters:])
                out += [(part, *row) for row in [*found, (-1, 0, n, *(len(m) for m in held[filters:]))]]
            columns = list(zip(*out, strict=True)) if out else [()] * (len(names) + 1)
            kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * (1 + marks)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["part", *names])

    schema = "part string, filter int, earlier int, removed long" + "".join(f", m{k} long" for k in range(marks))
    return lists.mapInArrow(merged, schema).groupBy("part", "filter", "earlier").agg(*(F.sum(c).alias(c) for c in names[2:]))


def audit(rows: DataFrame, part: str, id: str, fails: dict[str, Column], marks: dict[str, Column], lost: dict[str, str] | None = None) -> DataFrame:
    """Per part, order of the filters and step: part, filter_order, step, kept, removed, redundant, unique_fails, a column per mark, shapley.

    fails: filters by one-letter name, as conditions on `rows`; marks: conditions whose rows are counted among
    those removed (columns named by `lost`, or as the mark).  shapley is a filter's removed, summed over all orders.
    The orders are n! for n filters, so filters should be few.
    """
    names, n = list(fails), len(fails)
    lists = cut(postings(rows, part, id, fails, marks))
    at = lambda f, earlier: (f << n) | earlier
    key = F.when(F.col("filter") < 0, F.lit(-1)).otherwise(F.col("filter") * (1 << n) + F.col("earlier"))
    values = F.struct("removed", *(f"m{k}" for k in range(len(marks))))
    of_part = sizes(lists, n, len(marks)).groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(key.alias("k"), values.alias("v")))).alias("_of"))
    of_part = cut(of_part)  # n * 2^(n-1) entries and one a part
    steps = []
    for order in permutations(range(n)):
        before = 0
        for step, f in enumerate(order, 1):
            path = [at(g, sum(1 << h for h in order[:k])) for k, g in enumerate(order[:step])]
            steps.append(("".join(names[g] for g in order), step, f, at(f, before), path))
            before |= 1 << f
    value = lambda k, c="removed": F.col("_of")[k][c]
    share = lambda f: sum(
        (value(F.lit(at(f, s))) * (factorial(s.bit_count()) * factorial(n - 1 - s.bit_count())) for s in range(1 << n) if not s >> f & 1), F.lit(0)
    )
    all_others = [at(f, (1 << n) - 1 - (1 << f)) for f in range(n)]
    of_filter = {"_fails": lambda f: value(F.lit(at(f, 0))), "_only": lambda f: value(F.lit(all_others[f])), "_share": share}
    of_part = of_part.select("part", "_of", *(F.array(*map(of, range(n))).alias(c) for c, of in of_filter.items()))
    fields = ("filter_order", "step", "f", "k", "path")
    literal = F.lit(json.dumps([dict(zip(fields, s, strict=True)) for s in steps]))  # n * n! steps, whatever the input
    literal = F.from_json(literal, "array<struct<filter_order: string, step: int, f: int, k: int, path: array<int>>>")
    step = of_part.withColumn("_s", F.explode(literal))
    removed = value(F.col("_s.k"))
    kept = value(F.lit(-1)) - F.aggregate("_s.path", F.lit(0).cast("long"), lambda acc, k: acc + value(k))
    lost = lost or {}
    return step.select(
        "part",
        "_s.filter_order",
        "_s.step",
        kept.alias("kept"),
        removed.alias("removed"),
        (F.col("_fails")[F.col("_s.f")] - removed).alias("redundant"),
        F.col("_only")[F.col("_s.f")].alias("unique_fails"),
        *(value(F.col("_s.k"), f"m{k}").alias(lost.get(m, m)) for k, m in enumerate(marks)),
        F.col("_share")[F.col("_s.f")].alias("shapley"),
    )


def text_verdicts(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per row of `docs`: id, part, a to e (whether the text fails that filter), good, toxic.

    a: under 50 words; b: 100 * distinct words < 65 * words; c: 100 * letters A to Z > 5 * code points; d: a
    character of `SYMBOLS`; e: equal to the text of a smaller id (by 128-bit digests).  A null text is empty; a row
    without an id is no earlier copy, has none and no labels.  Labels that repeat an id count if one of them does.
    """

    def measured(parts):
        import xxhash

        for batch in parts:
            raw = [x or b"" for x in batch.column("text").to_pylist()]
            fails = []
            for t in raw:
                words = t.split()
                letters = len(t) - len(t.translate(None, _UPPER))
                points = len(t.decode("utf-8", "replace")) if letters else 0
                symbols = len(t.translate(None, SYMBOLS[1:-1])) < len(t)
                fails.append((len(words) < 50) | (100 * len(set(words)) < 65 * len(words)) << 1 | (100 * letters > 5 * points) << 2 | symbols << 3)
            same = [xxhash.xxh3_128_digest(t) for t in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("part"), pa.array(fails, pa.int32()), pa.array(same, pa.binary())], names=["id", "part", "fails", "same"]
            )

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(part).cast("string").alias("part"), F.col(text).cast("binary").alias("text"))
    seen = cut(rows.mapInArrow(measured, f"id {kind}, part string, fails int, same binary"))
    first = cut(seen.groupBy("same").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    known = labels.groupBy(F.col(id).alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    bit = lambda k: F.col("fails").bitwiseAND(1 << k) > 0
    # adaptive execution splits the rows of a text with very many copies
    return (
        seen.join(first, "same", "left")
        .join(known, "id", "left")
        .select("id", "part", *(bit(k).alias(c) for k, c in enumerate("abcd")), F.coalesce(F.col("first") < F.col("id"), F.lit(False)).alias("e"), "good", "toxic")
    )
