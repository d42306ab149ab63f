"""Mixing sources to target weights by a low-discrepancy schedule.  DataFrame functions only.

Every source is a stream of words: its documents in a keyed shuffle, cut into blocks of equally many
words.  The mix is a sequence of slots.  Slot i belongs to the source in whose part of the unit interval
(parts as long as the source's share of the slots) the i-th van der Corput point falls; the slots of a
source take its blocks in turn, again from the first when the stream is through.  So every prefix of the
mix has nearly the target shares.  A source gets exactly as many slots as its target needs: points too
many are void, slots still missing come at the end, and the last block is cut to the words left.

Null texts have no words; documents without words are never taken.  Rows that repeat are separate
documents.  A null source is a source of its own, the last in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import WORD, cut, numbered

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK_WORDS = 2048
#: Documents in one sorted piece of a source's shuffle, about.
PIECE = 4096
#: Equal parts of the unit interval by which points meet sources.
PARTS = 4096
#: Bits of a van der Corput point.
BITS = 50


def words(text: str = "text") -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: str = "source") -> Column:
    """A key whose order is the sources' order: by code point, null last."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source).cast("string")))


def numbered_rows(docs: DataFrame) -> DataFrame:
    """(_rid, _row): each row of `docs` as a struct, with a number of its own; write it before its numbers are used twice."""
    return docs.select(F.monotonically_increasing_id().alias("_rid"), F.struct("*").alias("_row"))


def sizes(rows: DataFrame, text: str = "text", source: str = "source", keep: tuple = ()) -> DataFrame:
    """Per row of `numbered_rows`: _rid, _hash, _key, size, and the columns to keep.

    The hash of the whole row orders the shuffle, so that it is the same however the rows are dealt;
    equal rows are interchangeable.
    """
    row = lambda c: f"_row.`{c}`"
    values = [F.col(row(f.name)).cast("string") for f in rows.schema["_row"].dataType.fields]
    return rows.select(
        "_rid", F.xxhash64(*values).alias("_hash"), source_key(row(source)).alias("_key"), words(row(text)).alias("size"), *(F.col(row(c)) for c in keep)
    )


def targets(sized: DataFrame, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per source (`_key`): source_size, docs, weight, target.

    Sources in order weigh as `weights`, repeating.  All words are shared by weight; a source stops at
    `most` times its size and the excess is shared again by weight until none is above.  That is the
    level at which min(weight * level, most * size) adds up to all words; the loop raises it until no
    further source is stopped, so it ends after as many rounds as there are sources at most.
    """
    sums = sized.groupBy("_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ranked, _ = numbered(sums, "_key", name="_rank")
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("_rank") % len(weights)).cast("int") + 1)
    shares = cut(ranked.withColumn("weight", weight).drop("_rank"))
    stop = F.col("source_size") * float(most)
    level = -1.0
    while True:
        stopped = stop <= F.col("weight") * F.lit(level)
        row = shares.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(stopped, stop)).alias("held"),
            F.sum(F.when(~stopped, F.col("weight"))).alias("open"),
        ).first()  # one row
        if not row["open"] or not row["all"]:
            break
        raised = (row["all"] - (row["held"] or 0.0)) / row["open"]
        if raised <= level:
            break
        level = raised
    return shares.withColumn("target", F.when(F.lit(level) > 0, F.least(stop, F.col("weight") * F.lit(max(level, 0.0)))).otherwise(F.lit(0.0)))


def _spread(hashed: Column, seed: int) -> Column:
    """A keyed hash as a number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), hashed), 11) / F.lit(float(2**53))


def streams(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """The documents with `begin`: the words before them in their source's shuffled stream.

    A source is cut into pieces of the hash range by its number of documents, so no task sorts a whole
    source; the words of earlier pieces are summed over one row per piece.
    """
    placed = (
        sized.join(sources.select("_key", "docs"), "_key")
        .withColumn("_at", _spread(F.col("_hash"), seed))
        .withColumn("_piece", F.floor(F.col("_at") * F.ceil(F.col("docs") / PIECE)).cast("long"))
        .drop("docs")
    )
    before = Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = placed.groupBy("_key", "_piece").agg(F.sum("size").alias("_words"))
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0))).drop("_words")
    inside = Window.partitionBy("_key", "_piece").orderBy("_at", "_rid").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(pieces, ["_key", "_piece"])
        .withColumn("begin", F.col("_before") + F.col("_inside"))
        .drop("_at", "_hash", "_piece", "_before", "_inside")
    )


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: slot, _key, rank (within the source), epoch, block, words.

    `slot` orders the mix; numbers may have gaps where a point was void.
    """
    need = F.floor("target").cast("long")
    plan = (
        sources.where("source_size > 0")
        .withColumn("_n", F.ceil(F.col("source_size") / block_words).cast("long"))
        .withColumn("_whole", F.expr("CAST(floor(target) AS BIGINT) div source_size"))
        .withColumn("_rest", need - F.col("_whole") * F.col("source_size"))
        .withColumn("_slots", F.col("_whole") * F.col("_n") + F.ceil(F.col("_rest") / block_words).cast("long"))
        .where("_slots > 0")
        .select("_key", "source_size", "_n", "_whole", "_rest", "_slots")
    )
    ordered, _ = numbered(plan, "_key", name="_rank")
    # cumulative slots: ranges of sources are few rows each, summed by number of the source
    upto = Window.partitionBy("_range").orderBy("_rank")
    ranges = ordered.withColumn("_range", F.expr(f"_rank div {PIECE}"))
    sums = ranges.groupBy("_range").agg(F.sum("_slots").alias("_sum"))
    sums = sums.withColumn(
        "_before", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    plan = cut(
        ranges.withColumn("_upto", F.sum("_slots").over(upto))
        .join(sums.drop("_sum"), "_range")
        .withColumn("_high", F.col("_before") + F.col("_upto"))
        .withColumn("_low", F.col("_high") - F.col("_slots"))
        .drop("_range", "_rank", "_before", "_upto")
    )
    total = plan.agg(F.sum("_slots")).first()[0] or 0  # one row
    spark = sources.sparkSession
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), BITS, "0")), 2, 10).cast("double") / F.lit(float(2**BITS))
    points = (
        spark.range(total)
        .withColumnRenamed("id", "slot")
        .withColumn("_v", point * F.lit(float(total)))
        .withColumn("_part", F.floor(F.col("_v") * F.lit(PARTS / max(total, 1))).cast("long"))
    )
    part_of = lambda v: F.floor(v * F.lit(PARTS / max(total, 1))).cast("long")
    parts = plan.withColumn("_part", F.explode(F.sequence(part_of(F.col("_low")), part_of(F.col("_high")))))
    met = points.join(parts, "_part").where("_v >= _low AND _v < _high").drop("_part", "_v")
    chunk = F.expr(f"slot div {PIECE}")
    met = met.withColumn("_chunk", chunk)
    counted = met.groupBy("_key", "_chunk").agg(F.count("*").alias("_c"))
    earlier = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_earlier", F.coalesce(F.sum("_c").over(earlier), F.lit(0))).drop("_c")
    within = Window.partitionBy("_key", "_chunk").orderBy("slot")
    ranked = (
        met.withColumn("_in", F.row_number().over(within) - 1)
        .join(counted, ["_key", "_chunk"])
        .withColumn("rank", F.col("_earlier") + F.col("_in"))
        .where("rank < _slots")
        .drop("_chunk", "_in", "_earlier")
    )
    found = ranked.groupBy("_key").agg(F.count("*").alias("_found"))
    missing = (
        plan.join(found, "_key", "left")
        .withColumn("_found", F.coalesce("_found", F.lit(0)))
        .where("_found < _slots")
        .withColumn("rank", F.explode(F.sequence(F.col("_found"), F.col("_slots") - 1)))
        .withColumn("slot", F.lit(total) + F.col("_low") + F.col("rank"))
        .drop("_found")
    )
    slots = ranked.unionByName(missing)
    block = F.col("rank") - F.col("epoch") * F.col("_n")
    left = F.when(F.col("epoch") < F.col("_whole"), F.col("source_size")).otherwise(F.col("_rest"))
    return (
        slots.withColumn("epoch", F.expr("rank div _n"))
        .withColumn("block", block)
        .withColumn("words", F.least(F.lit(block_words), left - F.col("block") * block_words))
        .select("slot", "_key", "rank", "epoch", "block", "words")
    )


def taken(streamed: DataFrame, slots: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document (`_rid`): the words that the slots take, repeats counted."""
    used = slots.groupBy("_key", "block").agg(F.collect_list("words").alias("_words"))
    pieces = (
        streamed.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.expr(f"begin div {block_words}"), F.expr(f"(begin + size - 1) div {block_words}"))))
        .withColumn("_from", F.greatest(F.col("begin") - F.col("block") * block_words, F.lit(0)))
        .withColumn("_to", F.least(F.col("begin") + F.col("size") - F.col("block") * block_words, F.lit(block_words)))
    )
    got = F.expr("aggregate(_words, CAST(0 AS BIGINT), (acc, w) -> acc + greatest(CAST(0 AS BIGINT), least(_to, w) - _from))")
    return pieces.join(used, ["_key", "block"]).groupBy("_rid").agg(F.sum(got).alias("taken"))


def plan_mix(sized: DataFrame, weights: tuple = WEIGHTS, most: float = MOST, block_words: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """Per row of `sized` of `sizes()` that has been written: _rid, size, source_size, target, taken."""
    sized = sized.select("_rid", "_hash", "_key", "size")
    sources = cut(targets(sized, weights, most))
    streamed = cut(streams(sized, sources, seed))
    got = taken(streamed, schedule(sources, block_words), block_words)
    return (
        streamed.join(sources.select("_key", "source_size", "target"), "_key")
        .join(got, "_rid", "left")
        .select("_rid", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed(docs: DataFrame, text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix as rows with the columns of `docs`: each document as often as it is taken.

    A document at the end of a source's quota is taken in part: its last copy, too, is the whole text, so a source has
    up to one document more than its target.
    """
    rows = cut(numbered_rows(docs))
    sized = cut(sizes(rows, text, source))
    plan = plan_mix(sized, **options).where("taken > 0")
    copies = F.expr("CAST(ceil(taken / size) AS INT)")
    out = rows.join(plan.select("_rid", copies.alias("_copies")), "_rid").withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
    return out.select(*(F.col(f"_row.`{c}`") for c in docs.columns))
