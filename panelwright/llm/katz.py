"""Katz backoff language model on words.

Tokens are the words of a text in lower case (ASCII letters) and one end token.  Unigram counts cover every
word of the training texts, bigram counts every pair of neighbours, the start and the end included.  Counts up to
`K` are discounted by Good-Turing; where the counts of counts do not give discounts within 0 and 1, absolute
discounting stands in.

    P(w | h) = d(r) r / c(h) * s(h)   if the pair has been seen r times,
    P(w | h) = a(h) P(w)              otherwise; a(h) = 1 for a context without pairs,
    P(w)     = d(r) r / N * s         for a known word; what is left goes to the unknown word.

a(h) is what the seen pairs of h leave, over the unigram mass of the words not seen after h, so the
probabilities of every context add up to 1; s is 1, or less where discounting would leave less than one count's
share.  Words are known by 64-bit hashes, pairs while scoring by a 64-bit hash of both.

The table of pairs is dealt to buckets by context, one row of packed arrays a bucket; there are more buckets the more
tokens there are.  A bucket knows all pairs of its contexts, hence their counts (what follows a word adds up to the
word's count) and weights.  Words with a share of `SHARED` of the training tokens or more, 1 / SHARED at most at
any size of the corpus, travel with the tasks with their counts and weights; the pairs of such a context are split over as
many buckets as its share asks for, and its sums are put together again.

A text's score is the sum of log a(h) + log P(w) over its tokens, and for the pairs that have been seen of what
they differ from that.  Scoring sends every distinct pair of a slice of documents once to its bucket, and every distinct
word that does not travel, and gets back sums for the documents that hold them.

Ids may be of any type that Arrow knows; a null id is the empty text as to whether it is held out.  Null and empty texts
are the end token alone.  Rows that repeat an id are separate documents.  A model of no documents knows no word, and
scores every text 0.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.bpe import slices
from panelwright.llm.common import cut, cut_by, gone, shuffle_partitions

SHARED = 1 / 200_000
K = 5
SLICE = 8_000_000
#: Training tokens in a bucket, about, where there are no more buckets than four a shuffle partition.
BUCKET_TOKENS = 2_000_000
START, END = 0, 1  # their numbers in the dictionary of shared words, which follow
_START_KEY, _END_KEY = 0, 1


def word_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens in a row, and the number of tokens of each text."""
    words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    flat = np.array([w for ws in words for w in ws], dtype=object)
    hashes = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
    keys = np.full(int(sizes.sum()), _END_KEY, np.int64)
    inner = np.ones(len(keys), bool)
    inner[np.cumsum(sizes) - 1] = False
    keys[inner] = hashes.view(np.int64)
    return keys, sizes


def held_out(ids: list) -> np.ndarray:
    """Documents that the model does not learn from: crc32 of the id as text divisible by 10."""
    return np.fromiter((zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i in ids), bool, len(ids))


def discounts(counts: dict[int, int], k: int = K) -> np.ndarray:
    """d(0..k) from the numbers of things seen r times; d(0) is not used."""
    n = [counts.get(r, 0) for r in range(k + 2)]
    if all(n[1:]):
        big = (k + 1) * n[k + 1] / n[1]
        d = [1.0] + [((r + 1) * n[r + 1] / n[r] / r - big) / (1 - big) if big < 1 else -1.0 for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d[1:]):
            return np.array(d)
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    return np.array([1.0] + [(r - absolute) / r for r in range(1, k + 1)])


def discounted(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    return n * np.where(n <= K, d[np.minimum(n, K)], 1.0)


def _slices(parts):
    """(number, ids, texts) of slices of the documents of a task."""
    number = 0
    for batch in parts:
        ids, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
        for a, b in slices(texts, SLICE):
            yield number, ids[a:b], texts[a:b]
            number += 1


def _runs(*sorted_arrays: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.ones(len(sorted_arrays[0]), bool)
    if len(new):
        new[1:] = np.any([a[1:] != a[:-1] for a in sorted_arrays], axis=0)
    return np.flatnonzero(new)


def _lengths(first: np.ndarray, total: int) -> np.ndarray:
    return np.diff(np.append(first, total))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first) if len(first) else values[:0]


class Words:
    """What travels with the tasks: the shared words and the numbers of the whole model."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, tokens: int, words: int, d1: np.ndarray, unknown: float, s1: float, buckets: int):
        #: Keys of the shared words in order; counts by number: the start (as a context), the end, the shared words.
        self.keys, self.counts, self.tokens, self.words, self.d1, self.unknown, self.s1, self.buckets = keys, counts, tokens, words, d1, unknown, s1, buckets
        self.splits = np.maximum(1, np.ceil(4 * counts * buckets / max(tokens, 1))).astype(np.int64)
        self.d2 = discounts({})
        self.log_a, self.log_s = np.zeros(len(counts)), np.zeros(len(counts))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of words in the dictionary; -1 for words that are not in it."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        found = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        return np.where(keys == _END_KEY, END, np.where(found, at + 2, -1))

    def keys_of(self, numbers: np.ndarray) -> np.ndarray:
        return np.concatenate([[_START_KEY, _END_KEY], self.keys]).astype(np.int64)[numbers]

    def context_numbers(self, keys: np.ndarray) -> np.ndarray:
        return np.where(keys == _START_KEY, START, self.numbers(keys))

    def bucket(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The bucket of each pair: its context's, or for a shared context one of several by the word."""
        number = self.context_numbers(h)
        splits = np.where(number >= 0, self.splits[np.maximum(number, 0)], 1).astype(np.uint64)
        part = (_mixed(w.view(np.uint64)) >> np.uint64(20)) % splits
        return (_mixed(h.view(np.uint64) + part * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.buckets)).astype(np.int64)

    def unigram(self, n: np.ndarray) -> np.ndarray:
        """P(w) by count; a count of 0 is the unknown word."""
        return np.where(n > 0, discounted(n, self.d1) / max(self.tokens, 1) * self.s1, self.unknown)

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.1) / (self.tokens + 0.1 * (self.words + 1)))

    def sums(self, cnt: np.ndarray, n: np.ndarray, n_w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(count, discounted mass, unigram mass of the words seen) of contexts with cnt pairs each."""
        first = np.cumsum(cnt) - cnt
        return _sums(n, first), _sums(discounted(n, self.d2), first), _sums(self.unigram(n_w), first)


def weights(c: np.ndarray, mass: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log a, log of what a discounted count is worth) of contexts."""
    left = np.maximum(1 - mass / c, 1 / (c + 1))
    return np.log10(left / np.maximum(1 - seen, 1e-300)), np.log10((1 - left) / mass)


def contexts(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The key of each token's predecessor."""
    before = np.empty_like(keys)
    before[1:] = keys[:-1]
    before[np.cumsum(sizes) - sizes] = _START_KEY
    return before


class Katz:
    """The model: a table of pairs with their words' counts (a row a bucket), and `words`, which can be broadcast."""

    def __init__(self, docs: DataFrame, id: str = "doc_id", text: str = "text"):
        spark = docs.sparkSession
        texts = docs.select(F.col(id), F.col(text))

        def unigrams(parts):
            for _, ids, texts in _slices(parts):
                keys, sizes = word_keys(texts)
                seen, n = np.unique(keys[np.repeat(~held_out(ids), sizes)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n.astype(np.int64))], names=["key", "n"])

        counted = texts.mapInArrow(unigrams, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        self.unigrams = cut(counted)  # until the pairs know their words' counts
        of_counts = [F.count_if(F.col("n") == r).alias(f"n{r}") for r in range(1, K + 2)]
        row = self.unigrams.agg(F.sum("n").alias("tokens"), F.count("*").alias("words"), *of_counts).first()  # one row
        tokens, known = row["tokens"] or 0, row["words"]
        d1 = discounts({r: row[f"n{r}"] for r in range(1, K + 2)})
        of_n = F.col("n") * F.when(F.col("n") <= K, F.element_at(F.array(*map(F.lit, d1.tolist())), (F.least("n", F.lit(K)) + 1).cast("int"))).otherwise(1.0)
        mass = self.unigrams.agg(F.sum(of_n)).first()[0] or 0.0
        unknown = max(1 - mass / tokens, 1 / (tokens + 1)) if tokens else 1.0
        s1 = (1 - unknown) * tokens / mass if mass else 1.0
        shared = self.unigrams.where((F.col("n") >= tokens * SHARED) | (F.col("key") == _END_KEY)).collect()  # 1 / SHARED + 1 at most
        n_of = {r["key"]: r["n"] for r in shared}
        ends = n_of.pop(_END_KEY, 0)
        keys = np.array(sorted(n_of), np.int64)
        counts = np.array([ends, ends, *(n_of[k] for k in keys.tolist())], np.int64)
        buckets = max(4 * shuffle_partitions(spark), -(-tokens // BUCKET_TOKENS))
        self.words = Words(keys, counts, tokens, known, d1, unknown, s1, buckets)
        self._pairs(texts)

    def _pairs(self, texts: DataFrame) -> None:
        spark = texts.sparkSession
        shared = spark.sparkContext.broadcast(self.words)

        def counted(parts):
            words = shared.value
            for _, ids, texts in _slices(parts):
                w, sizes = word_keys(texts)
                use = np.repeat(~held_out(ids), sizes)
                h, w = contexts(w, sizes)[use], w[use]
                bucket = words.bucket(h, w)
                yield _dealt(bucket, [h, w], lambda h, w: _table(words, h, w, np.ones(len(h), np.int64)))

        def merged(group: pa.Table) -> pa.Table:
            words = shared.value
            opened = [_columns(words, _opened(b)) for b in group.column("blob").to_pylist()]
            h, w, n = (np.concatenate(c) for c in zip(*((np.repeat(hs, cnt), w, n) for hs, cnt, w, n in opened), strict=True))
            out = _table(words, h, w, n)
            n = _opened(out)[5]
            of_counts = np.bincount(n[n <= K + 1].astype(np.int64), minlength=K + 2)
            return pa.table({"bucket": group.column("bucket")[:1], "blob": pa.array([out], pa.binary()), "counts": pa.array([of_counts.tolist()], pa.list_(pa.int64()))})

        rows = texts.mapInArrow(counted, "bucket int, blob binary")
        pairs = cut(rows.groupBy("bucket").applyInArrow(merged, "bucket int, blob binary, counts array<long>"))
        seen = pairs.agg(*(F.sum(F.col("counts")[r]).alias(f"n{r}") for r in range(1, K + 2))).first()  # one row
        self.words.d2 = discounts({r: seen[f"n{r}"] or 0 for r in range(1, K + 2)})
        shared = spark.sparkContext.broadcast(self.words)

        def asked(parts):
            for batch in parts:
                for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                    w = np.unique(_opened(blob)[4])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), bucket, np.int32)), pa.array(w)], names=["bucket", "key"])

        def with_counts(left: pa.Table, right: pa.Table) -> pa.Table:
            words = shared.value
            opened = _opened(left.column("blob")[0].as_py())
            hs, cnt, w, n = _columns(words, opened)
            key = right.column("key").to_numpy()
            order = np.argsort(key)
            key, of_key = key[order], right.column("n").to_numpy()[order]
            number = words.numbers(w)
            n_w = np.where(number >= 0, words.counts[np.maximum(number, 0)], 0)
            rare = number < 0
            n_w[rare] = of_key[np.searchsorted(key, w[rare])]
            split = words.context_numbers(hs) >= 0
            sums = [x[split] for x in words.sums(cnt, n, n_w)]
            lists = [pa.array([x.tolist()], t) for x, t in zip([hs[split], *sums], [pa.list_(pa.int64())] * 2 + [pa.list_(pa.float64())] * 2, strict=True)]
            blob = _squeezed([*opened, _small(n_w[rare])])
            return pa.Table.from_arrays([left.column("bucket")[:1], pa.array([blob], pa.binary()), *lists], names=["bucket", "blob", "h", "c", "mass", "seen"])

        # a rare word's count goes to the buckets that hold it after some context
        known = pairs.select("bucket", "blob").mapInArrow(asked, "bucket int, key long").join(self.unigrams, "key").select("bucket", "key", "n")
        both = pairs.select("bucket", "blob").groupBy("bucket").cogroup(known.groupBy("bucket"))
        self.pairs = cut_by(both.applyInArrow(with_counts, "bucket int, blob binary, h array<long>, c array<long>, mass array<double>, seen array<double>"), "bucket")
        gone(pairs, self.unigrams)
        parts = self.pairs.select(F.explode(F.arrays_zip("h", "c", "mass", "seen")).alias("x")).select("x.*")
        own = parts.groupBy("h").agg(*(F.sum(c).alias(c) for c in ("c", "mass", "seen"))).toPandas()  # the shared contexts
        if len(own):
            at = self.words.context_numbers(own["h"].to_numpy(np.int64))
            self.words.log_a[at], self.words.log_s[at] = weights(*(own[c].to_numpy(float) for c in ("c", "mass", "seen")))

    def scores(self, docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
        """Per row of `docs`: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
        shared = docs.sparkSession.sparkContext.broadcast(self.words)
        kind = docs.schema[id].dataType.simpleString()

        def requests(parts):
            from pyspark import TaskContext

            words, task = shared.value, TaskContext.get().partitionId()
            value = np.log10(words.unigram(words.counts)) + words.log_a  # the end is no context: its weight is 0
            for batch in parts:
                ids_of = batch.column(0)
                texts_of = [x or "" for x in batch.column(1).to_pylist()]
                for a, b in slices(texts_of, SLICE):
                    ids, texts = ids_of.slice(a, b - a), texts_of[a:b]
                    slice_id, number = task << 32 | requests.at, len(texts)
                    requests.at += 1
                    keys, sizes = word_keys(texts)
                    w = words.numbers(keys)
                    doc = np.repeat(np.arange(number), sizes)
                    own = w >= 0
                    # extended sums: what seen pairs take back is as large as these
                    plain = np.add.reduceat(np.where(own, value[w], 0.0).astype(np.longdouble), np.cumsum(sizes) - sizes)
                    n = words.counts[np.maximum(w, 0)]
                    sums = [plain.astype(float) + words.log_a[START], np.bincount(doc, np.where(own, words.base(n), 0.0), number), np.bincount(doc, own & (n > 0), number)]
                    blob = _squeezed([*sums, sizes])
                    yield _rows(slice_id, [slice_id % words.buckets], [blob], pa.ListArray.from_arrays(pa.array([0, number], pa.int32()), ids))
                    h = contexts(keys, sizes)
                    for of_pairs in (True, False):
                        key, d, bucket = (_pair(h, keys), doc, words.bucket(h, keys)) if of_pairs else (keys[~own], doc[~own], words.bucket(keys[~own], keys[~own]))
                        out = _dealt(bucket, [key, d], lambda key, d: _request(of_pairs, key, d, number))  # noqa: B023
                        yield _rows(slice_id, out.column(0), out.column(1), pa.nulls(out.num_rows, pa.list_(ids.type)))

        def _rows(slice_id, buckets, blobs, ids):
            buckets = pa.array(buckets, pa.int32())
            return pa.RecordBatch.from_arrays([pa.array([slice_id] * len(buckets), pa.int64()), buckets, pa.array(blobs, pa.binary()), ids], names=["slice", "bucket", "blob", "ids"])

        requests.at = 0

        def answers(left: pa.Table, right: pa.Table) -> pa.Table:
            words = shared.value
            index = _index(words, right.column("blob")[0].as_py()) if right.num_rows else None
            out = [[], [], []]
            for slice_id, blob, ids in zip(left.column("slice").to_pylist(), left.column("blob").to_pylist(), left.column("ids"), strict=True):
                if ids.is_valid:
                    out[0].append(slice_id), out[1].append(blob), out[2].append(ids)
                    continue
                (of_pairs, number), key, per_key, d, times = _opened(blob)
                key, d, times = np.cumsum(key).view(np.int64), d.astype(np.int64), times.astype(np.int64)
                n, more = _found(index, of_pairs, key)
                if of_pairs:
                    if not (n > 0).any():
                        continue
                    values = [more, np.zeros(len(n)), np.zeros(len(n))]
                else:
                    values = [np.log10(words.unigram(n)) + more, words.base(n), (n > 0).astype(float)]
                at, inverse = np.unique(d, return_inverse=True)
                sums = [np.bincount(inverse, np.repeat(v, per_key) * times, len(at)) for v in values]
                out[0].append(slice_id), out[1].append(_squeezed([at, *sums])), out[2].append(None)
            kinds = (pa.int64(), pa.binary(), left.schema.field("ids").type)
            return pa.table([pa.array([x.as_py() if isinstance(x, pa.Scalar) else x for x in c], t) for c, t in zip(out, kinds, strict=True)], names=["slice", "blob", "ids"])

        def summed(group: pa.Table) -> pa.Table:
            rows = list(zip(group.column("blob").to_pylist(), group.column("ids"), strict=True))
            ids = next(i for _, i in rows if i.is_valid).values
            total = np.zeros((3, len(ids)))
            for blob, own in rows:
                if own.is_valid:
                    *sums, sizes = _opened(blob)
                    total += sums
                else:
                    at, *sums = _opened(blob)
                    total[:, at] += sums
            columns = {
                id: ids,
                "held_out": pa.array(held_out(ids.to_pylist())),
                "n_tokens": pa.array(sizes.astype(np.int64)),
                "n_known": pa.array(np.rint(total[2]).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(ids), tokens, np.int64)),
                "base_score": pa.array(total[1]),
                "score": pa.array(total[0]),
            }
            return pa.table(columns)

        tokens = self.words.tokens
        asked = docs.select(F.col(id), F.col(text)).mapInArrow(requests, f"slice long, bucket int, blob binary, ids array<{kind}>")
        pairs = self.pairs.select("bucket", "blob")
        answered = asked.groupBy("bucket").cogroup(pairs.groupBy("bucket")).applyInArrow(answers, f"slice long, blob binary, ids array<{kind}>")
        return answered.groupBy("slice").applyInArrow(
            summed, f"`{id}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        )


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(33))


def _pair(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of keys; no two pairs of one context share a key."""
    x = h.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x = (x * np.uint64(0x94D049BB133111EB) + w.view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def _dealt(bucket: np.ndarray, columns: list[np.ndarray], packed) -> pa.RecordBatch:
    """(bucket, blob): the rows of each bucket as `packed` makes them."""
    by = np.argsort(bucket, kind="stable")
    columns, bucket = [c[by] for c in columns], bucket[by]
    first = _runs(bucket)
    blobs = [packed(*(c[a:b] for c in columns)) for a, b in zip(first, np.append(first, len(bucket))[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first].astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "blob"])


def _table(words: Words, h: np.ndarray, w: np.ndarray, n: np.ndarray) -> bytes:
    """Distinct pairs with the sums of their counts: contexts, pairs a context, which words are shared (bits), the numbers of
    those, the keys of the others, counts."""
    order = np.lexsort((w, h))
    h, w, n = h[order], w[order], n[order]
    first = _runs(h, w)
    h, w, n = h[first], w[first], _sums(n, first)
    at = _runs(h)
    number = words.numbers(w)
    own = number >= 0
    return _squeezed([h[at], _lengths(at, len(h)), np.packbits(own), _small(number[own]), w[~own], _small(n)])


def _columns(words: Words, opened: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, pairs a context, words and counts of a table."""
    hs, cnt, bits, number, rest, n = opened[:6]
    own = np.unpackbits(bits, count=len(n)).astype(bool)
    w = np.empty(len(n), np.int64)
    w[own], w[~own] = words.keys_of(number.astype(np.int64)), rest
    return hs, cnt, w, n.astype(np.int64)


def _request(of_pairs: bool, key: np.ndarray, doc: np.ndarray, documents: int) -> bytes:
    """Distinct keys in unsigned order (as differences), documents a key, documents, times."""
    key = key.view(np.uint64)
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    first = _runs(key, doc)
    times = _lengths(first, len(key))
    key, doc = key[first], doc[first]
    at = _runs(key)
    return _squeezed([np.array([of_pairs, documents], np.int64), np.diff(key[at], prepend=np.uint64(0)), _small(_lengths(at, len(key))), _small(doc), _small(times)])


def _index(words: Words, blob: bytes) -> dict:
    """What a bucket answers from: sorted keys of words and pairs with counts and values."""
    opened = _opened(blob)
    hs, cnt, w, n = _columns(words, opened)
    number = words.numbers(w)
    n_w = words.counts[np.maximum(number, 0)]
    n_w[number < 0] = opened[6]
    c, mass, seen = words.sums(cnt, n, n_w)
    log_a, log_s = weights(c.astype(float), mass, seen)
    number = words.context_numbers(hs)
    shared = number >= 0
    log_a[shared], log_s[shared] = words.log_a[number[shared]], words.log_s[number[shared]]
    pair = _pair(np.repeat(hs, cnt), w)
    value = np.log10(discounted(n, words.d2)) + np.repeat(log_s - log_a, cnt) - np.log10(words.unigram(n_w))
    order = np.argsort(pair.view(np.uint64))
    own = np.flatnonzero(~shared)
    own = own[np.argsort(hs[own].view(np.uint64))]
    return {True: (pair.view(np.uint64)[order], n[order], value[order]), False: (hs.view(np.uint64)[own], c[own], log_a[own])}


def _found(index: dict | None, of_pairs: bool, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count, value) of keys; 0 and 0 for those that the bucket does not hold."""
    known, n, value = index[of_pairs] if index else (np.zeros(0, np.uint64),) * 3
    if not len(known):
        return np.zeros(len(key), np.int64), np.zeros(len(key))
    key = key.view(np.uint64)
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    held = known[at] == key
    return np.where(held, n[at], 0), np.where(held, value[at], 0.0)


def _small(a: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the fewest bytes."""
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a


def _squeezed(arrays: list[np.ndarray]) -> bytes:
    """Arrays one after the other, byte by byte of their items, compressed."""
    import pickle

    import zstandard

    planes = [(a.dtype.str, np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(planes))


def _opened(blob: bytes) -> list[np.ndarray]:
    import pickle

    import zstandard

    planes = pickle.loads(zstandard.ZstdDecompressor().decompress(blob))
    return [np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(np.dtype(t).itemsize, -1).T).reshape(-1).view(t) for t, b in planes]
