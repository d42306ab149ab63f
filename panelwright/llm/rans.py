"""Token ids in a compact binary format: static range asymmetric numeral system (rANS).

One table of symbol frequencies, counted over all documents and scaled to a power of two, serves every
block.  A block holds whole consecutive documents; its ids run through `LANES` interleaved coders, each
with a 64-bit state and 32-bit output words, so numpy codes all lanes at once.  Blocks are independent:
each has its own header, checksum and checkpoints (lane states and word offsets at regular steps), from
which a reader starts in the middle or several readers share a block.

The file format is a table of such blocks (`payload`) with their index (range, first_id, number of documents and ids),
next to the frequency table; Spark writes it, so it can be in any store that Spark reads.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.bpe import KEPT, Recent, batch_slices, joined
from panelwright.llm.common import given_back, new_folder, shuffle_partitions, shuffles_end, worker_memo

MAGIC = b"RANSBLK1"
SCALE_BITS = 20
LANES = 2048
#: Coding steps (of up to LANES ids each) from one checkpoint to the next, and ids in a block, about.
CHECKPOINT, BLOCK_IDS = 256, 1 << 20
#: Code points of text that are tokenised together, about.
SLICE = 6_000_000
_LOW = 31  # states stay within 2**31 and 2**63
_HEADER = "<8sIQQIII"  # magic, documents, ids, words, checkpoints, crc of ids, crc of the rest


def scaled(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that add up to 2**bits, at least 1 for every id that occurs; largest remainders."""
    total, target = int(counts.sum()), 1 << bits
    if total == 0:
        return np.zeros(len(counts), np.int64)
    seen = counts > 0
    spare = target - int(seen.sum())
    if spare < 0:
        raise ValueError("more symbols than slots")
    share = counts * (spare / total)
    freq = np.where(seen, 1 + np.floor(share), 0).astype(np.int64)
    rest = target - int(freq.sum())
    order = np.argsort(-(share - np.floor(share)) - 2 * seen, kind="stable")[: int(seen.sum())]
    if rest > 0:
        np.add.at(freq, np.resize(order, rest), 1)
    elif rest < 0:  # rounding of the product
        freq[np.argmax(freq)] += rest
    return freq


class Table:
    """Frequencies with what coder and decoder look up."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.begin = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.most = self.freq << np.uint64(63 - SCALE_BITS)


def encode_block(sizes: np.ndarray, ids: np.ndarray, table: Table) -> bytes:
    """One block from the documents' sizes and their ids in a row."""
    n = len(ids)
    steps = -(-n // LANES)
    state = np.full(LANES, 1 << _LOW, np.uint64)
    words, marks = [], []
    written = 0
    scale, half = np.uint64(SCALE_BITS), np.uint64(32)
    for step in range(steps - 1, -1, -1):  # the decoder runs forwards
        if (step + 1) % CHECKPOINT == 0 and step + 1 < steps:
            marks.append((step + 1, written, state.copy()))
        sym = ids[step * LANES : (step + 1) * LANES]
        f, b, s = table.freq[sym], table.begin[sym], state[: len(sym)]
        over = s >= table.most[sym]
        if over.any():
            out = (s[over] & np.uint64(0xFFFFFFFF)).astype("<u4")
            words.append(out[::-1])  # reversed as a whole below
            written += len(out)
            s = np.where(over, s >> half, s)
        q = s // f
        state[: len(sym)] = (q << scale) + (s - q * f) + b
    stream = np.concatenate(words)[::-1] if words else np.zeros(0, "<u4")
    body = b"".join(
        (
            np.asarray(sizes, "<u4").tobytes(),
            state.astype("<u8").tobytes(),
            b"".join(struct.pack("<QQ", step, written - at) + lanes.astype("<u8").tobytes() for step, at, lanes in reversed(marks)),
            stream.tobytes(),
        )
    )
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    return struct.pack(_HEADER, MAGIC, len(sizes), n, len(stream), len(marks), crc, zlib.crc32(body)) + body


def decode_block(payload: bytes, table: Table, from_step: int = 0, to_step: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The documents' sizes and the ids from one step to another (a whole block is checked)."""
    magic, docs, n, length, n_marks, ids_crc, body_crc = struct.unpack_from(_HEADER, payload)
    body = memoryview(payload)[struct.calcsize(_HEADER) :]
    if magic != MAGIC or zlib.crc32(body) != body_crc:
        raise ValueError("damaged block")
    at = docs * 4
    sizes = np.frombuffer(body, "<u4", docs)
    state = np.frombuffer(body, "<u8", LANES, at).astype(np.uint64)
    at += LANES * 8
    step, used = 0, 0
    for _ in range(n_marks):
        mark, offset = struct.unpack_from("<QQ", body, at)
        if mark <= from_step:
            step, used = mark, offset
            state = np.frombuffer(body, "<u8", LANES, at + 16).astype(np.uint64)
        at += 16 + LANES * 8
    stream = np.frombuffer(body, "<u4", length, at).astype(np.uint64)
    steps = -(-n // LANES)
    last = steps if to_step is None else min(to_step, steps)
    out = []
    mask, scale, low, half = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(1 << _LOW), np.uint64(32)
    for step in range(step, last):
        s = state[: min(LANES, n - step * LANES)]
        slot = s & mask
        sym = table.symbol[slot]
        s = table.freq[sym] * (s >> scale) + slot - table.begin[sym]
        short = s < low
        k = int(np.count_nonzero(short))
        if k:
            s[short] = (s[short] << half) | stream[used : used + k]
            used += k
        state[: len(s)] = s
        if step >= from_step:
            out.append(sym)
    ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
    if from_step == 0 and last == steps and zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("ids do not match their checksum")
    return sizes, ids


# Kinds of bytes, as the pattern of byte-level tokenizers sees them: what is OPEN may be of any kind, a lead byte of kind MAY may begin a space.
_OPEN, _ALNUM, _PUNCT, _QUOTE, _BLANK, _WHITE, _LETTER, _MAY = range(8)
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _PUNCT
for _set, _kind in ((b"\t\n\v\f\r", _WHITE), (b" ", _BLANK), (b"'", _QUOTE), (range(0xC3, 0xF5), _LETTER), (b"\xc2\xe1\xe2\xe3", _MAY)):
    _KIND[list(_set)] = _kind
_KIND[[b for b in range(128) if chr(b).isalnum()]] = _ALNUM
#: Pairs of kinds that the pattern parts, and pairs of white space and what is surely none.
_PARTED, _BEFORE_WORD = np.zeros(64, bool), np.zeros(64, bool)
_PARTED[[_ALNUM << 3 | _PUNCT, _ALNUM << 3 | _QUOTE, _PUNCT << 3 | _ALNUM]] = True
_PARTED[[x << 3 | y for x in (_ALNUM, _PUNCT, _QUOTE) for y in (_BLANK, _WHITE)]] = True
_BEFORE_WORD[[x << 3 | y for x in (_BLANK, _WHITE) for y in (_ALNUM, _PUNCT, _QUOTE, _LETTER)]] = True

#: A piece in which line ends around it change nothing.
_JOINABLE = r"^ ?[^\x00-\x20\x7f-\x{a0}\x{180e}\pZ]+$"


def cut_pieces(texts: pa.Array, whole: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Pieces of texts (large strings), one at least of each, and how many there are up to each text's end.

    A cut is where 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ ends a match whatever is around:
    before white space that follows ASCII, before the last white space ahead of a word, after it too unless it is a blank,
    between an ASCII letter or digit and an ASCII sign, and the other way round unless the sign is an apostrophe.  So a piece
    on its own has the ids that it has in its text.  Texts marked `whole` are not cut.
    """
    _, offsets, buffer = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if offsets else np.zeros(1, np.int64)
    end = int(offsets[-1])
    data = np.frombuffer(buffer or b"", np.uint8)[:end]
    kinds = _KIND[data]
    pairs = kinds[:-1] << 3 | kinds[1:]
    inner = offsets[(offsets > 0) & (offsets < end)]
    pairs[inner - 1] = 0  # of two texts
    starts = np.zeros(end + 1, bool)
    starts[1:end][_PARTED[pairs]] = True
    at = np.flatnonzero(_BEFORE_WORD[pairs])
    # A lead byte that may begin a space is looked at with what follows.
    may = np.flatnonzero((pairs == (_BLANK << 3 | _MAY)) | (pairs == (_WHITE << 3 | _MAY)))
    if len(may):
        after = [data[np.minimum(may + k, end - 1)].astype(np.int64) for k in (1, 2, 3)]
        two, three = after[0] << 8 | after[1], after[0] << 16 | after[1] << 8 | after[2]
        space = (two == 0xC285) | (two == 0xC2A0) | (three == 0xE19A80) | (three == 0xE1A08E) | (three == 0xE38080)
        space |= ((three >= 0xE28080) & (three <= 0xE2808F)) | ((three >= 0xE280A8) & (three <= 0xE280AF)) | ((three >= 0xE2819F) & (three <= 0xE281AF))
        at = np.append(at, may[~space])
    starts[at] = True
    starts[at[kinds[at] == _WHITE] + 1] = True
    for k in np.flatnonzero(whole):
        starts[offsets[k] : offsets[k + 1]] = False
    empty = offsets[1:] == offsets[:-1]
    starts[offsets[:-1][~empty]] = True
    found = np.flatnonzero(starts[:end])
    ends = np.searchsorted(found, offsets[1:]) + np.cumsum(empty)
    if empty.any():
        found = np.sort(np.append(found, offsets[:-1][empty]))
    edges = np.append(found, end).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(found), [None, pa.py_buffer(edges), buffer or pa.py_buffer(b"")]), ends


class Tokens:
    """Ids of texts by the tokenizers library; a piece between two cuts of the pattern is encoded seldom more than once a worker.

    Texts that spell a special token are encoded whole, since what is around it then counts; so are all texts for a
    tokenizer that does not cut by the byte-level pattern alone.
    """

    def __init__(self, tokenizer_json: str):
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        cutter = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer is not None else {}
        by_pattern = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
        #: Whether texts can be cut.
        self.cuts = by_pattern and self.tokenizer.normalizer is None and not self.tokenizer.truncation and not self.tokenizer.padding
        #: Type of an id: two bytes if all ids fit.
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        line = self._ids("\n")
        #: Id of a line end, which parts two pieces that have none.
        self.line = line[0] if self.cuts and len(line) == 1 else None
        self.forget()

    def forget(self) -> None:
        self.recent = Recent(pa.large_string(), size=4 * KEPT)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _lines(self, pieces: list[str]) -> pa.Array:
        """Ids of pieces: many at a time, a line end between them."""
        plain = pc.match_substring_regex(pa.array(pieces, pa.large_string()), _JOINABLE).to_numpy(zero_copy_only=False) & (self.line is not None)
        order = np.append(np.flatnonzero(plain), np.flatnonzero(~plain))
        n_plain = int(plain.sum())
        ids, sizes = [], [np.zeros(1, np.int64)]
        for k in range(0, n_plain, 512):
            group = [pieces[i] for i in order[k : min(k + 512, n_plain)].tolist()]
            found = self._ids("\n".join(group))
            ends = found == self.line
            own = np.diff(np.flatnonzero(ends), prepend=-1, append=len(found)) - 1
            if len(own) == len(group):
                ids.append(found[~ends])
            else:
                ids += (singly := [self._ids(p) for p in group])
                own = np.array([len(x) for x in singly], np.int64)
            sizes.append(own)
        for i in order[n_plain:].tolist():
            ids.append(self._ids(pieces[i]))
            sizes.append(np.array([len(ids[-1])], np.int64))
        cut = np.cumsum(np.concatenate(sizes)) * self.kind.itemsize
        data = np.concatenate(ids).tobytes() if ids else b""
        made = pa.Array.from_buffers(pa.large_binary(), len(pieces), [None, pa.py_buffer(cut), pa.py_buffer(data)])
        return made.take(pa.array(np.argsort(order)))

    def _chunks(self, chunks: list[str]) -> pa.Array:
        """Ids of pieces that begin with a space, given without it."""
        return self._lines([" " + c for c in chunks])

    def _pieces(self, pieces: pa.Array) -> list[pa.Array]:
        """Ids of distinct pieces."""
        given = pieces.to_pylist()
        spaced = np.fromiter((p[:1] == " " for p in given), bool, len(given))
        order = np.append(np.flatnonzero(spaced), np.flatnonzero(~spaced))
        made = [self._chunks([p[1:] for p in given if p[:1] == " "]), self._lines([p for p in given if p[:1] != " "])]
        return [pa.concat_arrays(made).take(pa.array(np.argsort(order)))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; every distinct piece once, and texts are then put together by number."""
        column = pa.array(texts, pa.large_string())
        whole = np.full(len(texts), not self.cuts)
        for s in self.specials:
            whole |= pc.match_substring(column, s).to_numpy(zero_copy_only=False)
        pieces, ends = cut_pieces(column, whole)
        coded = pieces.dictionary_encode()
        return joined(self.recent.known(coded.dictionary, self._pieces)[0], coded.indices.to_numpy(), ends).to_pylist()


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, width, ids): the whole text's ids and the end id, in integers of `width` bytes; null counts as empty."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())  # one vocabulary

    def batches(parts):
        memo = worker_memo("tokens")
        key = hash(definition.value)
        if key not in memo:
            memo.clear()
            memo[key] = Tokens(definition.value)
        tokens = memo[key]
        end, width = np.array([end_id], tokens.kind).tobytes(), tokens.kind.itemsize
        for batch in parts:
            for rows, texts in batch_slices(batch, batch.schema.names[1], SLICE):
                ids = [x + end for x in tokens.encode(texts)]
                sizes, widths = pa.array([len(x) // width for x in ids], pa.int64()), pa.array([width] * len(ids), pa.int32())
                yield pa.RecordBatch.from_arrays([rows.column(0), sizes, widths, pa.array(ids, pa.binary())], names=["id", "n_tokens", "width", "ids"])
        given_back()

    return docs.select(F.col(id).alias("id"), F.col(text)).mapInArrow(batches, f"id {docs.schema[id].dataType.simpleString()}, n_tokens long, width int, ids binary")


def _numbers(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, f"=u{width}")


def frequencies(tokens: DataFrame) -> np.ndarray:
    """Scaled frequencies of all ids: counted per task, summed by id; a row an id comes to the driver."""

    def counts(parts):
        total = np.zeros(0, np.int64)
        for batch in parts:
            if batch.num_rows:
                c = np.bincount(_numbers(b"".join(batch.column(1).to_pylist()), batch.column(0)[0].as_py()))
                if len(c) > len(total):
                    total, c = c.astype(np.int64), total
                total[: len(c)] += c
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["token", "n"])

    rows = tokens.select("width", "ids").mapInArrow(counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(int(rows["token"].max()) + 1 if len(rows) else 1, np.int64)
    out[rows["token"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return scaled(out)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents in ascending id order: `path`/blocks and `path`/table.

    Documents are tokenised once into a table in the shared folder, range-partitioned by id, and coded
    block by block, so a task holds a block and no more.  Rows of equal id are in order of their ids' bytes.
    """
    spark = docs.sparkSession
    kept = new_folder(spark)
    tokenized(docs, tokenizer, end_id, id, text).write.option("compression", "zstd").parquet(kept)
    tokens = spark.read.parquet(kept)
    freq = frequencies(tokens)
    spark.createDataFrame(pd.DataFrame({"token": np.arange(len(freq)), "freq": freq})).coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(freq)  # one vocabulary
    ranged = tokens.repartitionByRange(shuffle_partitions(spark), "id", "n_tokens").sortWithinPartitions("id", "ids")

    def blocks(parts):
        from pyspark import TaskContext

        table = Table(shared.value)
        part = TaskContext.get().partitionId()
        held, held_ids, block, before = [], 0, 0, 0

        def flush():
            nonlocal held, held_ids, block, before
            data = _numbers(b"".join(x for _, x in held), width)
            sizes = np.fromiter((len(x) // width for _, x in held), np.int64, len(held))
            row = pd.DataFrame({"range": [part], "block": [block], "before": [before], "n_ids": [len(data)]}).astype(np.int64)
            batch = pa.RecordBatch.from_pandas(row, preserve_index=False)
            columns = [*batch.columns, pa.array([[i for i, _ in held]], pa.list_(id_type)), pa.array([encode_block(sizes, data, table)], pa.binary())]
            block, before = block + 1, before + len(data)
            held, held_ids = [], 0
            return pa.RecordBatch.from_arrays(columns, names=["range", "block", "before", "n_ids", "doc_ids", "payload"])

        id_type, width = None, 4
        for batch in parts:
            id_type = batch.schema.field("id").type
            for i, width, x in zip(*(batch.column(c).to_pylist() for c in ("id", "width", "ids")), strict=True):
                held.append((i, x))
                held_ids += len(x) // width
                if held_ids >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    kind = tokens.schema["id"].dataType.simpleString()
    schema = f"range long, block long, before long, n_ids long, doc_ids array<{kind}>, payload binary"
    with shuffles_end(spark):
        ranged.select("id", "width", "ids").mapInArrow(blocks, schema).write.parquet(f"{path}/blocks")


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in files of this format, decoded block by block.

    start: ids of all documents before it; the sums of the ranges (as many as shuffle partitions) give the
    ranges' offsets.
    """
    freq = spark.read.parquet(f"{path}/table").orderBy("token").toPandas()["freq"].to_numpy(np.int64)  # one vocabulary
    shared = spark.sparkContext.broadcast(freq)
    blocks = spark.read.parquet(f"{path}/blocks")
    offsets, total = {}, 0
    for part, n in sorted(map(tuple, blocks.groupBy("range").agg(F.sum("n_ids")).collect())):
        offsets[part] = total
        total += n

    def docs(parts):
        table = Table(shared.value)
        for batch in parts:
            kind = batch.schema.field("doc_ids").type.value_type
            for part, before, ids, payload in zip(*(batch.column(c).to_pylist() for c in ("range", "before", "doc_ids", "payload")), strict=True):
                sizes, data = decode_block(payload, table)
                ends = np.cumsum(sizes.astype(np.int64))
                begins = ends - sizes
                raw = data.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, kind),
                        pa.array(begins + before + offsets[part], pa.int64()),
                        pa.array(sizes.astype(np.int64), pa.int64()),
                        pa.array([raw[a * 4 : b * 4] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.select("range", "before", "doc_ids", "payload").mapInArrow(docs, f"doc_id {kind}, start long, n_tokens long, ids binary")
