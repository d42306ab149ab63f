"""Near-duplicates by SetSketch registers.

A document's set holds its distinct shingles of `shingle` words (ASCII letters in lower case; a shorter text is one
shingle; a null, empty or blank text has none and is linked with nothing).  A register keeps the least of
an exponential hash of the shingles as a truncated logarithm; registers merge by maximum, and two sets
agree in one with about their Jaccard similarity.

1. Equal sets (128-bit digest) form a class; its least id stands for it.
2. Bands of registers put classes into buckets.  Every class of a bucket is paired with the bucket's
   centre, the class whose buckets hold most classes (in a group of edited copies, the text they come
   from); pairs are estimated jointly by maximum likelihood from the registers, and what may reach the
   threshold (four standard errors below it) is verified on the full sets.  The differences from the centre are kept.
3. Links join components.  A bucket that still holds several components is searched in small blocks for
   the pairs between components, unless their distances to the bucket's centre already rule a link out.  They
   are estimated in the same way and verified by their differences from the centre, within the task; only what was
   not near enough to the centre to be compared with it goes on as a pair.  So no bucket is
   capped, no link between classes in a common bucket is lost, and pairs within a component are not made.

With 28 bands of 5 registers a pair at a similarity of 0.85 shares no bucket with probability 7e-8, at
0.8 with probability 1.5e-5.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.bpe import slices
from panelwright.llm.common import cut, tidy

BANDS, ROWS = 28, 5
REGISTERS = BANDS * ROWS
#: Base, rate and largest value of the registers (16 bits).
BASE, RATE, TOP = 1.001, 20.0, 65535
SIMILARITY = 85
BLOCK = 64


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], width: int = 3) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    words = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    flat = [w for ws in words for w in ws]
    hashes = pd.util.hash_array(np.array(flat, dtype=object), categorize=False) if flat else np.zeros(0, np.uint64)
    out, at = [], 0
    for ws in words:
        h = hashes[at : at + len(ws)]
        at += len(ws)
        k = min(width, len(h))
        mix = np.full(max(len(h) - k + 1, 0) if k else 0, k, np.uint64)
        for j in range(k):
            mix = _mixed(mix * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(mix)])
        out.append(np.unique(mix))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """The registers of one set of hashes."""
    odd = _mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)
    least = np.full(REGISTERS, np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 1024):
        x = shingles[None, at : at + 1024] * odd[:, None]
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        np.minimum(least, x.min(axis=1), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit key of every band's registers and its number; the last axis holds the registers."""
    bands = regs.reshape(*regs.shape[:-1], BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:-1])
    for k in range(ROWS):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bands[..., k])
    return keys.view(np.int64)


def joint_similarity(more: np.ndarray, less: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Maximum likelihood of the Jaccard similarity of sets of sizes a and b.

    `more` and `less` count the registers in which the first is above or below the second.  The likelihood
    is concave, so its maximum is where the slope changes sign, or at an end of the possible range.
    """
    u, v = a / (a + b), b / (a + b)
    c, same = (BASE - 1) / BASE, REGISTERS - more - less
    p = lambda x: -np.log1p(-x * c) / np.log(BASE)
    dp = lambda x: c / (1 - x * c) / np.log(BASE)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    tiny = 1e-12
    for _ in range(40):
        j = (low + high) / 2
        x, y = np.maximum(u - v * j, tiny), np.maximum(v - u * j, tiny)
        slope = -more * v * dp(x) / p(x) - less * u * dp(y) / p(y) + same * (v * dp(x) + u * dp(y)) / np.maximum(1 - p(x) - p(y), tiny)
        up = slope > 0
        low, high = np.where(up, j, low), np.where(up, high, j)
    return (low + high) / 2


def may_link(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    """Pairs (rows) whose estimate is no more than four standard errors below the threshold."""
    limit, total = percent / 100, n_a
    fits = np.flatnonzero(100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))
    regs_a, regs_b, n_a, n_b = regs_a[fits], regs_b[fits], n_a[fits].astype(float), n_b[fits].astype(float)
    more, less = (regs_a > regs_b).sum(axis=1), (regs_a < regs_b).sum(axis=1)
    floor = limit - 4 * np.sqrt(limit * (1 - limit) / REGISTERS)
    out = np.zeros(len(total), bool)
    out[fits] = joint_similarity(more, less, n_a, n_b) >= floor
    return out


def sketches(docs: DataFrame, id: str, text: str, width: int) -> DataFrame:
    """(id, n_shingles, same, regs, bands) of every row."""

    def batches(parts):
        import xxhash

        for batch in parts:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                sets = shingle_sets(texts[a:b], width)
                regs = [registers(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([None if r is None else r.astype("<u2").tobytes() for r in regs], pa.binary()),
                        pa.array([None if r is None else band_keys(r) for r in regs], pa.list_(pa.int64())),
                    ],
                    names=["id", "n_shingles", "same", "regs", "bands"],
                )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id).alias("id"), F.col(text)).mapInArrow(
        tidy(batches), f"id {kind}, n_shingles long, same binary, regs binary, bands array<long>"
    )


def _estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may be links."""
    side = lambda x: classes.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}"))

    def kept(parts):
        for batch in parts:
            if batch.num_rows:
                view = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS)
                size = lambda c: batch.column(c).to_numpy()
                yield batch.select(["a", "b"]).filter(pa.array(may_link(view("regs_a"), view("regs_b"), size("n_a"), size("n_b"), percent)))

    kind = pairs.schema["a"].dataType.simpleString()
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(tidy(kept), f"a {kind}, b {kind}")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with the sizes of their full sets' intersection and union, and what only one of them holds: a, b, both, either, only_a, only_b."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"set_{x}"))

    def kept(parts):
        for batch in parts:
            both, either, only_a, only_b = [], [], [], []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                alone, other = np.setdiff1d(p, q, assume_unique=True), np.setdiff1d(q, p, assume_unique=True)
                both.append(len(p) - len(alone))
                either.append(len(p) + len(other))
                only_a.append(alone.tobytes())
                only_b.append(other.tobytes())
            columns = [batch.column("a"), batch.column("b"), pa.array(both, pa.int64()), pa.array(either, pa.int64()), pa.array(only_a, pa.binary()), pa.array(only_b, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "both", "either", "only_a", "only_b"])

    kind = pairs.schema["a"].dataType.simpleString()
    paired = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "set_a", "set_b")
    return paired.mapInArrow(tidy(kept), f"a {kind}, b {kind}, both long, either long, only_a binary, only_b binary")


def _links(compared: DataFrame, percent: int) -> DataFrame:
    return compared.where(100 * F.col("both") >= percent * F.col("either")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every linked id: the least id that it reaches.

    Labels go to neighbours and are then shortened by their own labels, so long chains halve each round;
    each round is written to the shared folder.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("_low")).select("id", F.least("id", "_low").alias("component")))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("_near"))
        nearer = labels.join(near, "id").select("id", F.col("component").alias("_old"), F.least("component", "_near").alias("_new"))
        jump = labels.select(F.col("id").alias("_new"), F.col("component").alias("_far"))
        after = cut(nearer.join(jump, "_new", "left").select("id", "_old", F.least("_new", F.coalesce("_far", "_new")).alias("component")))
        labels = after.drop("_old")
        if after.where("component <> _old").isEmpty():
            return labels


def _cross_pairs(open_rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links (sure) and pairs that may be links of one bucket's rows in different components, from blocks of few rows.

    open_rows: key, id, label, head (label of the bucket's centre), apart (Jaccard distance to the centre), gone and
    fresh (what the row lacks of the centre and has beyond it; these three null if not compared), rows and strangers (rows with
    another label).  The distance is a metric, so two rows whose distances to their centre differ by more than a link
    allows are no link.  Two rows that have been compared with the centre are verified on the spot by their
    differences from it, and one link stands for all between two components.  Rows with the head's label meet the
    strangers' blocks alone; strangers meet all.
    """
    row = open_rows.join(classes.select("id", "n_shingles", "regs"), "id").withColumn("_own", F.col("label") == F.col("head"))
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    spread = F.abs(F.xxhash64("id") % 1000003)
    heads, others = blocks(F.col("rows") - F.col("strangers")), blocks(F.col("strangers"))
    # blocks of strangers are numbered from 0, those of the head's component from -1 downwards
    row = row.withColumn("_block", F.when(F.col("_own"), -1 - spread % heads).otherwise(spread % others).cast("int"))
    upwards, downwards = F.sequence(F.lit(0), others - 1), F.sequence(F.lit(-1), -heads, F.lit(-1))
    low_high = lambda x: F.struct(F.least(x, F.col("_block")).alias("x"), F.greatest(x, F.col("_block")).alias("y"))
    met = F.when(F.col("_own"), upwards).otherwise(F.concat(upwards, downwards))
    dealt = row.withColumn("_pair", F.explode(F.transform(met, low_high))).select(
        "key", F.col("_pair.x").alias("_x"), F.col("_pair.y").alias("_y"), "_block", "id", "label", "apart", "gone", "fresh", "n_shingles", "regs"
    )
    dealt = dealt.repartition("key", "_x", "_y").sortWithinPartitions("key", "_x", "_y", "id")
    kind = classes.schema["id"].dataType.simpleString()

    def pairs(parts):
        held = None
        for batch in parts:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            starts = _starts(held)
            if len(starts) > 1:
                yield from _block_pairs(held.slice(0, starts[-1]), percent)
                held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield from _block_pairs(held, percent)

    return dealt.mapInArrow(tidy(pairs), f"a {kind}, b {kind}, sure boolean").distinct()


def _starts(rows: pa.Table) -> np.ndarray:
    """Where the groups of equal key and blocks begin in sorted rows."""
    if not rows.num_rows:
        return np.zeros(0, np.int64)
    of = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("key", "_x", "_y")])
    return np.append(0, 1 + np.flatnonzero((of[:, 1:] != of[:, :-1]).any(axis=0)))


def _block_pairs(rows: pa.Table, percent: int, at_once: int = 200_000):
    """Batches (a, b, sure) of the pairs in whole groups, of which the least band that both share is the group's."""
    column = lambda c: rows.column(c).to_numpy()
    ids, labels, sizes, blocks, keys, x, y, apart = map(column, ("id", "label", "n_shingles", "_block", "key", "_x", "_y", "apart"))
    apart = apart.astype(float)
    known = ~np.isnan(apart)
    gone, fresh = ([np.frombuffer(x or b"", np.uint64) for x in rows.column(c).to_pylist()] for c in ("gone", "fresh"))
    regs = np.frombuffer(b"".join(rows.column("regs").to_pylist()), "<u2").reshape(-1, REGISTERS)
    bands = band_keys(regs)
    starts = _starts(rows)
    ends = np.append(starts[1:], rows.num_rows)
    later = np.repeat(ends, ends - starts) - np.arange(rows.num_rows) - 1  # rows that follow in the group
    upto = np.cumsum(later)
    at = 0
    while at < rows.num_rows:
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + at_once, "right")))
        n = later[at:to]
        i = np.repeat(np.arange(at, to), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        use = (labels[i] != labels[j]) & (ids[i] != ids[j]) & ((x[i] == y[i]) | (blocks[i] != blocks[j]))
        use &= 100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j])
        use &= ~(np.abs(apart[i] - apart[j]) > 1 - percent / 100 + 1e-9)  # unknown distances stay
        i, j = i[use], j[use]
        shared = bands[i] == bands[j]
        first = np.take_along_axis(bands[i], shared.argmax(axis=1)[:, None], 1)[:, 0] == keys[i]
        i, j = i[first], j[first]
        fits = may_link(regs[i], regs[j], sizes[i], sizes[j], percent)
        i, j = i[fits], j[fits]
        sure = known[i] & known[j]
        keep = ~sure
        for k in np.flatnonzero(sure).tolist():
            p, q = int(i[k]), int(j[k])
            centre = sizes[p] - len(fresh[p]) + len(gone[p])
            lacking = len(gone[p]) + len(gone[q]) - len(np.intersect1d(gone[p], gone[q], assume_unique=True))
            both = centre - lacking + len(np.intersect1d(fresh[p], fresh[q], assume_unique=True))
            keep[k] = 100 * both >= percent * (sizes[p] + sizes[q] - both)
        i, j, sure = i[keep], j[keep], sure[keep]
        joined = np.stack([np.minimum(labels[i], labels[j]), np.maximum(labels[i], labels[j])])
        one = np.unique(np.where(sure, joined, np.stack([-1 - np.arange(len(i))] * 2)), axis=1, return_index=True)[1] if len(i) else i
        i, j, sure = i[one], j[one], sure[one]
        columns = [pa.array(np.maximum(ids[i], ids[j])), pa.array(np.minimum(ids[i], ids[j])), pa.array(sure)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "sure"])
        at = to


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, percent: int = SIMILARITY) -> DataFrame:
    """Per row of `docs`: id, n_shingles, component_id, kept.

    Ids are integers and name documents: rows that repeat an id are one document, which is linked with whatever one of
    its texts is linked with.  Rows without an id are kept and have no component.  component_id: the least id that links
    reach; kept: that document itself.
    """
    if docs.schema[id].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"ids must be integers: {id}")
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = cut(sketches(docs, "id", "text", width))
    sets_of = rows.where("n_shingles > 0 AND id IS NOT NULL")
    # classes have numbers of their own: a document with several texts is in several
    leasts = cut(sets_of.groupBy("same").agg(F.min("id").alias("rep")).withColumn("class", F.monotonically_increasing_id()))
    found = sets_of.join(leasts, "same").where("id = rep").dropDuplicates(["same"])
    classes = cut(found.select(F.col("class").alias("id"), "rep", "n_shingles", "regs", "bands", "same"))
    in_bands = classes.select("id", F.explode("bands").alias("key"))
    shared = cut(in_bands.join(in_bands.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1"), "key"))
    weights = shared.groupBy("id").agg(F.sum("rows").alias("_weight"))
    centres = shared.join(weights, "id").groupBy("key").agg(F.max_by("id", F.struct("_weight", -F.col("id"))).alias("centre"))
    held = cut(shared.join(centres, "key"))  # classes that share a bucket
    stars = held.where("id <> centre").select(F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b")).distinct()
    candidates = cut(_estimated(stars, classes, percent))
    wanted = classes.join(held.select("id").distinct(), "id").select(F.col("rep").alias("id"), "same", F.col("id").alias("class"))
    texts = docs.join(wanted, "id").select("class", "same", "text")

    def full(parts):
        import xxhash

        for batch in parts:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for a, b in slices(texts):
                sets = [s.tobytes() for s in shingle_sets(texts[a:b], width)]
                own = pa.array([xxhash.xxh3_128_digest(s) == d for s, d in zip(sets, batch.column("same").slice(a, b - a).to_pylist(), strict=True)])
                out = pa.RecordBatch.from_arrays([batch.column("class").slice(a, b - a), pa.array(sets, pa.binary())], names=["id", "shingles"])
                yield out.filter(own)

    sets = cut(texts.mapInArrow(tidy(full), "id long, shingles binary").dropDuplicates(["id"]))
    compared = cut(_compared(candidates, sets))
    links = _links(compared, percent)
    several = cut(sets_of.groupBy("id").agg(F.min("same").alias("_one"), F.max("same").alias("_two")).where("_one <> _two").select("id"))
    if not several.isEmpty():
        twins = cut(sets_of.join(several, "id").select("id", "same").distinct().join(leasts, "same").select("id", "class"))
        least = twins.groupBy("id").agg(F.min("class").alias("b"))
        links = links.unionByName(twins.join(least, "id").where("class <> b").select(F.col("class").alias("a"), "b"))
    links = cut(links)
    labels = components(links)

    to_centre = compared.select("a", "b", (1 - F.col("both") / F.col("either")).alias("apart"), "only_a", "only_b")
    placed = held.withColumns({"a": F.greatest("id", "centre"), "b": F.least("id", "centre")}).join(to_centre, ["a", "b"], "left")
    own, first = F.col("id") == F.col("centre"), F.col("id") == F.col("a")
    placed = placed.withColumns(
        {
            "apart": F.when(own, 0.0).otherwise(F.col("apart")),
            "gone": F.when(own, F.lit(b"")).when(first, F.col("only_b")).otherwise(F.col("only_a")),
            "fresh": F.when(own, F.lit(b"")).when(first, F.col("only_a")).otherwise(F.col("only_b")),
        }
    ).drop("a", "b", "only_a", "only_b")
    named = placed.join(labels, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component")
    head = named.where("id = centre").select("key", F.col("label").alias("head")).dropDuplicates(["key"])
    placed = cut(named.join(head, "key"))
    strangers = placed.where("label <> head").groupBy("key").agg(F.count("*").alias("strangers"))
    open_rows = placed.join(strangers, "key").select("key", "id", "label", "head", "apart", "gone", "fresh", "rows", "strangers")
    more = cut(_cross_pairs(open_rows, classes, percent))
    more = cut(more.where("sure").select("a", "b").unionByName(_links(_compared(more.where("NOT sure").select("a", "b"), sets), percent)))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    # a component is named by the least id in it
    of_component = labels.join(classes.select("id", "rep"), "id")
    least = of_component.groupBy("component").agg(F.min("rep").alias("_class"))
    named = of_component.join(least, "component").select("id", "_class")
    of_class = cut(classes.select("same", "id", "rep").join(named, "id", "left").select("same", F.coalesce("_class", "rep").alias("_class")))
    joined = rows.select("id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("same")).alias("same")).join(of_class, "same", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("_class", "id"))
    return joined.select(
        F.col("id").alias(id), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )
