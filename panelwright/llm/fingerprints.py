"""Order MinHash fingerprints.  DataFrame functions only.

A text is the sequence of its k-mers (k words in a row); equal k-mers are told apart by their occurrence
number.  The hash of (k-mer, occurrence) deals them into bins and orders them there; every bin keeps its
least `TUPLE` k-mers in the order in which they stand in the text and hashes that tuple.  Two texts agree
in a bin if the same least k-mers stand there in the same order, which edits and moved passages break: a
likeness for edit distance, where a plain MinHash sees only the set.

A fingerprint is the list of its bins' cells (bin number and tuple hash), as hexadecimal text.  Likeness is
the share of equal cells among the bins that either text fills.  Null counts as empty; an empty text (or
one of white space alone) has an empty fingerprint, like another empty one by 1 and any other text by 0.
A text of fewer than k words is one k-mer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import cut, numbered

K = 2
TUPLE = 2
BIN_BITS = 6
CELL_BITS = 32 - BIN_BITS
_SHIFT = 64 - BIN_BITS


def with_cells(df: DataFrame, text: str, into: str) -> DataFrame:
    """Add the cells of a text column, an array of int in bin order.

    The work is inside the row: one sort brings equal k-mers together (runs of equals give the occurrence
    numbers), one sort by hash brings the bins together.  Linear but for the sorts; no shuffle.
    """
    w, k, s, e, b = (f"_{into}_{x}" for x in "wkseb")
    kept = df.columns
    df = df.withColumn(
        w, F.expr(rf"filter(split({text}, '[\\x20\\x09-\\x0D]+'), x -> x <> '')")
    ).withColumn(
        k,
        F.expr(
            f"CASE WHEN coalesce(size({w}), 0) < 1 THEN array() WHEN size({w}) < {K} THEN array(xxhash64(array_join({w}, ' '))) "
            f"ELSE transform(sequence(0, size({w}) - {K}), i -> xxhash64({', '.join(f'{w}[i + {j}]' for j in range(K))})) END"
        ),
    )
    df = df.withColumn(s, F.expr(f"sort_array(transform({k}, (x, i) -> named_struct('k', x, 'p', i)))"))
    runs = f"filter(transform({s}, (x, j) -> if(j = 0 OR {s}[j - 1].k <> x.k, j, -1)), j -> j >= 0)"
    numbers = (
        f"element_at(transform(array({runs}), r -> flatten(zip_with(r, concat(slice(r, 2, greatest(size(r) - 1, 0)), array(size({s}))), "
        f"(a, z) -> sequence(0, z - a - 1)))), 1)"
    )
    df = df.withColumn(
        e,
        F.expr(
            f"if(size({s}) = 0, array(), sort_array(zip_with({s}, {numbers}, (x, o) -> named_struct('v', xxhash64(x.k, o), 'p', x.p))))"
        ),
    )
    least = f"filter({e}, (x, j) -> j < {TUPLE} OR shiftright({e}[j - {TUPLE}].v, {_SHIFT}) <> shiftright(x.v, {_SHIFT}))"
    df = df.withColumn(b, F.expr(f"sort_array(transform({least}, x -> named_struct('b', shiftright(x.v, {_SHIFT}), 'p', x.p, 'v', x.v)))"))
    others = "".join(f", if(get({b}, j + {t}).b = x.b, get({b}, j + {t}).v, NULL)" for t in range(1, TUPLE))
    cell = f"CAST(shiftleft(x.b, {CELL_BITS}) | (xxhash64(x.v{others}) & {(1 << CELL_BITS) - 1}) AS INT)"
    cells = f"filter(transform({b}, (x, j) -> if(j > 0 AND {b}[j - 1].b = x.b, NULL, {cell})), c -> c IS NOT NULL)"
    return df.select(*kept, F.expr(cells).alias(into))


def as_text(cells: str) -> Column:
    """The fingerprint: eight hexadecimal digits a cell."""
    return F.expr(f"array_join(transform({cells}, c -> lpad(hex(CAST(c AS BIGINT) & 4294967295), 8, '0')), '')")


def likeness(a: str, b: str) -> Column:
    """Share of equal cells among the bins that either fills; 1 if both are empty."""
    bins = lambda c: f"transform({c}, x -> shiftright(x, {CELL_BITS}))"
    return F.expr(
        f"CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1.0D "
        f"ELSE size(array_intersect({a}, {b})) / CAST(size(array_union({bins(a)}, {bins(b)})) AS DOUBLE) END"
    )


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of `docs` and `fingerprint` (instead of a column of that name)."""
    rows = docs.drop("fingerprint").select(F.struct("*").alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return with_cells(rows, "_text", "_cells").select("_row.*", as_text("_cells").alias("fingerprint"))


def edited_against_next(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text against its edited form and the next document.

    Edited: the last quarter (floor) of the code points gives way to as many first ones of the next document
    in ascending id (after the last, the first).  Rows with equal id and text are one document and get the same
    result each.  Texts are shuffled once, by row; the next document sends no more than the code points asked for.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    row = F.xxhash64(F.coalesce(F.col(id).cast("string"), F.lit("null")), whole)
    narrow = docs.select(row.alias("_k"), F.col(id).alias("doc_id"), F.char_length(whole).cast("long").alias("n_chars")).distinct()
    order, n = numbered(narrow, "doc_id", "_k")
    order = cut(order)
    following = order.select(F.col("_k").alias("_prev"), ((F.col("row_no") + 1) % max(n, 1)).alias("row_no"), F.expr("n_chars div 4").alias("_q"))
    links = cut(following.join(order.select("_k", "row_no"), "row_no").drop("row_no"))
    texts = docs.select(row.alias("_k"), whole.alias("_text"))
    heads = (
        texts.join(links, "_k")
        .select("_prev", F.expr("substring(_text, 1, CAST(_q AS INT))").alias("_head"))
        .groupBy("_prev")
        .agg(F.first("_head").alias("_head"))
    )
    own = order.select("_k", "doc_id", "n_chars").join(links.select(F.col("_prev").alias("_k"), F.col("_k").alias("_next")), "_k")
    both = texts.join(own, "_k").join(heads.withColumnRenamed("_prev", "_k"), "_k")
    both = both.withColumn("_edited", F.expr("concat(substring(_text, 1, CAST(n_chars - n_chars div 4 AS INT)), _head)"))
    both = with_cells(with_cells(both, "_text", "_cells"), "_edited", "_edited_cells")
    done = cut(
        both.select(
            "_k", "_next", "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "_cells", "_edited_cells",
            likeness("_cells", "_edited_cells").alias("near_edited"),
        )
    )
    nexts = done.select(F.col("_k").alias("_next"), F.col("_cells").alias("_next_cells")).dropDuplicates(["_next"])
    return done.join(nexts, "_next").select(
        "doc_id", "n_chars", "edited_sha256", as_text("_cells").alias("fingerprint"), as_text("_edited_cells").alias("edited_fingerprint"),
        "near_edited", likeness("_cells", "_next_cells").alias("near_next"),
    )
