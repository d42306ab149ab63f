"""Byte-level BPE encoding and decoding by recursive DuckDB queries in each partition.

A text is cut by the tokenizer's pattern; distinct words meet the merge table as rows (word, position,
token).  A recursive query contracts in every word the leftmost pair of least rank, all words at once,
until no word holds a pair of the table.  Decoding joins tokens with their bytes and aggregates them in
order.  A task keeps what it has encoded and decoded lately in Arrow columns of bounded size, so a word is
contracted seldom more than once a task, and texts are put together by the numbers of their chunks; nothing
is shuffled.

Null and empty texts have no ids.  Every byte is a token, so decoding gives the UTF-8 text back exactly.
"""

from __future__ import annotations

import base64
import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, StructField, StructType

from panelwright.llm.common import given_back, tidy, worker_memo

#: Code points of text handled at a time, and entries that a task keeps of each kind.
SLICE, KEPT = 2_000_000, 300_000
#: Rows of a recursion or of a decoding at a time, at most: n tokens make n(n+1)/2 rows in their recursion, all steps together.
ROWS = 500_000
#: Words of more bytes are contracted by a heap: the recursion takes a step a merge, over all tokens left.
LONG = 256
_GLUED = re.compile(r" (?:\s|\Z)")

# A row of the recursion is a token at `loc`: the word's number and the token's first byte in one integer.
CONTRACT = """
WITH RECURSIVE tokens AS (
  SELECT CAST(word AS BIGINT) << 20 | pos AS loc, token, true AS open FROM first_tokens
  UNION ALL
  (WITH pairs AS MATERIALIZED (
    SELECT t.loc, t.token, t.next_loc, CAST(m.merged AS BIGINT) << 20 | (t.loc & 1048575) AS rank_at
    FROM (
      SELECT loc, token, lead(token) OVER w AS next_token, lead(loc) OVER w AS next_loc
      FROM tokens WHERE open WINDOW w AS (ORDER BY loc)
    ) t LEFT JOIN merges m ON m.left_token = t.token AND m.right_token = t.next_token AND t.loc >> 20 = t.next_loc >> 20
  ), best AS (
    SELECT loc >> 20 AS word, min(rank_at) AS best, arg_min(next_loc, rank_at) AS eaten FROM pairs WHERE rank_at IS NOT NULL GROUP BY 1
  )
  SELECT loc, CASE WHEN loc & 1048575 = best & 1048575 THEN CAST(best >> 20 AS INT) ELSE token END, best IS NOT NULL
  FROM pairs LEFT JOIN best ON best.word = loc >> 20 WHERE eaten IS NULL OR loc <> eaten)
)
SELECT CAST(loc >> 20 AS INT) AS word, token FROM tokens WHERE NOT open ORDER BY loc
"""

DECODE = """
SELECT sequence, string_agg(piece, '' ORDER BY pos) AS decoded
FROM ids JOIN pieces USING (token) GROUP BY sequence ORDER BY sequence
"""


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def contract_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same contraction of one long word by a heap of pairs, in n log n."""
    n = len(word)
    end = list(range(1, n + 1))  # end[i]: where the token that starts at i ends; 0 if none starts there
    before = list(range(-1, n - 1))
    heap = []

    def push(i: int) -> None:
        if (j := end[i]) < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, j, end[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, j, k = heapq.heappop(heap)
        if end[i] != j or j >= n or end[j] != k:
            continue  # one of the two has been merged meanwhile
        end[i], end[j] = k, 0
        if k < n:
            before[k] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


def split_chunks(text: str) -> tuple[str, list[str]]:
    """The text before its first chunk, and the chunks without their leading space.

    The pattern always cuts before a space that a non-space follows; a chunk reaches from one such space
    to the next, so its words do not depend on what is around it.
    """
    parts = text.split(" ")
    if _GLUED.search(text) is None:
        return parts[0], parts[1:]
    joined = [parts[0]]
    for part in parts[1:]:
        if not part or part[0].isspace():
            joined[-1] += " " + part
        else:
            joined.append(part)
    return joined[0], joined[1:]


def distinct_pieces(texts: list[str], split=split_chunks) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct heads and chunks of texts, their numbers in text order, and how many there are up to each text's end.

    A head is given with a space before it, which no chunk begins with.
    """
    flat, counts = [], []
    for text in texts:
        head, chunks = split(text)
        flat.append(" " + head)
        flat += chunks
        counts.append(len(chunks) + 1)
    coded = pa.array(flat, pa.large_string()).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.cumsum(counts, dtype=np.int64)


def joined(pieces: pa.Array, numbers: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The pieces of these numbers in a row, as one value up to each of `ends`."""
    flat = pieces.take(pa.array(numbers))
    if not len(flat):
        return pa.array([b""] * len(ends), pa.large_binary())
    _, offsets, data = flat.buffers()
    cut = np.frombuffer(offsets, np.int64)[np.append(0, ends) + flat.offset]
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(cut), data or pa.py_buffer(b"")])


class Recent:
    """What was asked for lately, in Arrow columns: about `size` entries of 64 bytes, or a call's if it has more."""

    def __init__(self, keys: pa.DataType, columns: int = 1, size: int = KEPT):
        self.size, self.keys, self.values = size, pa.array([], keys), [pa.array([], pa.large_binary())] * columns

    def known(self, keys: pa.Array, make) -> list[pa.Array]:
        """The values of distinct keys; `make` gives those of new ones, a column each."""
        at = pc.index_in(keys, value_set=self.keys)
        new = pc.is_null(at)
        missing = keys.filter(new)
        numbers = at.fill_null(0).to_numpy().astype(np.int64)
        if len(missing):
            numbers[new.to_numpy(zero_copy_only=False)] = len(self.keys) + np.arange(len(missing))
            self.keys = pa.concat_arrays([self.keys, missing])
            self.values = [pa.concat_arrays([a, b.cast(pa.large_binary())]) for a, b in zip(self.values, make(missing), strict=True)]
        found = [a.take(pa.array(numbers)) for a in self.values]
        if len(self.keys) > self.size or self.keys.nbytes + sum(a.nbytes for a in self.values) > 64 * self.size:
            self.keys, self.values = keys, found
        return found


class Codec:
    """Encoder and decoder of one worker; needs `regex` and `duckdb`."""

    def __init__(self, rank_file: bytes, pattern: str):
        import duckdb
        import regex

        self.ranks = read_ranks(rank_file)
        self.words = regex.compile(pattern).findall
        size = max(self.ranks.values()) + 1
        self.first = np.zeros(256, np.int32)
        self.space_first = np.zeros(size, bool)
        pairs, pieces = [], []
        for token, rank in self.ranks.items():
            if len(token) == 1:
                self.first[token[0]] = rank
            self.space_first[rank] = token[:1] == b" "
            pieces.append((rank, token.decode("latin-1")))
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left, right, rank))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self._table("merges", ("left_token", "right_token", "merged"), pairs)
        self._table("pieces", ("token", "piece"), pieces)
        self.forget()

    def forget(self) -> None:
        """Let go of what the last task encoded and decoded; the tables stay with the worker."""
        self.words_known, self.pieces_known = ({n: Recent(pa.large_string(), n) for n in (1, 2)} for _ in range(2))
        self.sequence_bytes = Recent(pa.large_binary())

    def _table(self, name: str, columns: tuple, rows: list) -> None:
        given = pa.table([pa.array(c, pa.string() if c and isinstance(c[0], str) else pa.int32()) for c in zip(*rows, strict=True)], names=columns)
        self.db.register("given", given)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _query(self, name: str, given: pa.Table, sql: str) -> pa.Table:
        self.db.register(name, given)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit integers) of distinct words."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        return [ids for a, b in runs(sizes * (sizes + 1) // 2, ROWS) for ids in self._contracted(words[a:b], sizes[a:b])]

    def _contracted(self, words: list[bytes], sizes: np.ndarray) -> list[bytes]:
        data = self.first[np.frombuffer(b"".join(words), np.uint8)]
        begins = np.cumsum(sizes) - sizes
        given = pa.table(
            {
                "word": np.repeat(np.arange(len(words), dtype=np.int32), sizes),
                "pos": (np.arange(len(data)) - np.repeat(begins, sizes)).astype(np.int32),
                "token": data,
            }
        )
        rows = self._query("first_tokens", given, CONTRACT)
        flat = rows.column("token").to_numpy().astype("<u4").tobytes()
        ends = (np.cumsum(np.bincount(rows.column("word").to_numpy(), minlength=len(words))) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _decoded(self, sequences: list[bytes]) -> list[bytes]:
        """Bytes of distinct id sequences."""
        sizes = np.fromiter(map(len, sequences), np.int64, len(sequences)) // 4
        out = []
        for a, b in runs(sizes, ROWS):
            own = sizes[a:b]
            given = pa.table(
                {
                    "sequence": np.repeat(np.arange(b - a, dtype=np.int32), own),
                    "pos": (np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)).astype(np.int32),
                    "token": np.frombuffer(b"".join(sequences[a:b]), "<u4").astype(np.int32),
                }
            )
            rows = self._query("ids", given, DECODE)
            made = [b""] * (b - a)  # a sequence without ids has no row
            for k, x in zip(rows.column("sequence").to_pylist(), rows.column("decoded").to_pylist(), strict=True):
                made[k] = x.encode("latin-1")
            out += made
        return out

    def _words(self, words: pa.Array, back: bool) -> list[pa.Array]:
        """Ids of distinct words and, with `back`, what they decode to."""
        coded = [w.encode() for w in words.to_pylist()]
        ids = [b"" if len(w) <= LONG else np.array(contract_long(w, self.ranks), "<u4").tobytes() for w in coded]
        short = [k for k, w in enumerate(coded) if len(w) <= LONG]
        for k, x in zip(short, self.contract([coded[k] for k in short]), strict=True):
            ids[k] = x
        return [pa.array(x, pa.large_binary()) for x in ([ids, self._decoded(ids)] if back else [ids])]

    def _cut(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        """Words of chunks with their leading space, and how many there are up to each chunk's end; all in one search."""
        words = self.words(" " + " ".join(chunks)) if chunks else []
        upto = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        edges = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1)
        ends = np.searchsorted(upto, edges) + 1
        if len(ends) and (ends[-1] != len(words) or (upto[ends - 1] != edges).any()):
            raise ValueError("the pattern does not cut before each space that a non-space follows, or leaves text out")
        return words, ends

    def _pieces(self, pieces: pa.Array, back: bool) -> list[pa.Array]:
        """As `_words`, of distinct heads and chunks."""
        given = pieces.to_pylist()
        is_head = np.array([p[0] == " " for p in given], bool)
        words, ends = self._cut([p for p in given if p[0] != " "])
        heads = [self.words(p[1:]) for p in given if p[0] == " "]
        coded = pa.array([*words, *(w for h in heads for w in h)], pa.large_string()).dictionary_encode()
        ends = np.append(ends, len(words) + np.cumsum([len(h) for h in heads], dtype=np.int64)).astype(np.int64)
        known = self.words_known[1 + back].known(coded.dictionary, lambda new: self._words(new, back))
        place = np.empty(len(given), np.int64)  # chunks come first, then heads
        place[np.flatnonzero(~is_head)] = np.arange(len(given) - len(heads))
        place[np.flatnonzero(is_head)] = len(given) - len(heads) + np.arange(len(heads))
        return [joined(column, coded.indices.to_numpy(), ends).take(pa.array(place)) for column in known]

    def encode_columns(self, texts: list[str], back: bool = False) -> list[pa.Array]:
        """Ids of each text and, with `back`, what they decode to; equal chunks are encoded and decoded once."""
        pieces, numbers, ends = distinct_pieces(texts)
        known = self.pieces_known[1 + back].known(pieces, lambda new: self._pieces(new, back))
        return [joined(column, numbers, ends) for column in known]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        return self.encode_columns(texts)[0].to_pylist()

    def decode_column(self, ids: list[bytes]) -> pa.Array:
        """Bytes of each id sequence, which is cut before every token that begins with a space; equal parts are decoded once."""
        data = b"".join(ids)
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        edges = np.union1d(np.flatnonzero(self.space_first[np.frombuffer(data, "<u4")]) * 4, np.append(0, ends)).astype(np.int64)
        parts = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        known = self.sequence_bytes.known(coded.dictionary, lambda new: [pa.array(self._decoded(new.to_pylist()), pa.large_binary())])
        return joined(known[0], coded.indices.to_numpy(), np.searchsorted(edges, ends))

    def decode(self, ids: list[bytes]) -> list[bytes]:
        return self.decode_column(ids).to_pylist()


def runs(sizes: np.ndarray, most: int):
    """(from, to) of runs of sizes that add up to `most` at most, or of one."""
    upto, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = int(upto[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, before + most, "right")))
        yield begin, end
        begin = end


def slices(texts: list[str], size: int = SLICE):
    """(from, to) of runs of texts with about `size` code points, one text at least."""
    begin, held = 0, 0
    for k, t in enumerate(texts):
        if held and held + len(t) > size:
            yield begin, k
            begin, held = k, 0
        held += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def batch_slices(batch: pa.RecordBatch, column: str, size: int = SLICE):
    """(rows, values) of slices of a batch with about `size` code points or bytes in the column, one row at least; null is empty."""
    values = batch.column(column)
    text = pa.types.is_string(values.type) or pa.types.is_large_string(values.type)
    empty = "" if text else b""
    sizes = (pc.utf8_length if text else pc.binary_length)(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    for a, b in runs(sizes, size):
        yield batch.slice(a, b - a), [x or empty for x in values.slice(a, b - a).to_pylist()]


def _codec(rank_file: bytes, pattern: str) -> Codec:
    memo = worker_memo("bpe")
    key = (hash(rank_file), pattern)
    if key not in memo:
        memo.clear()
        memo[key] = Codec(rank_file, pattern)
    return memo[key]


def _mapped(df: DataFrame, ranks: str, pattern: str, column: str, added: list[str], work) -> DataFrame:
    """All columns of `df` and binary columns that `work(codec, values)` makes of `column`, slice by slice.

    Columns of `df` with those names are replaced.
    """
    df = df.drop(*added)
    spark: SparkSession = df.sparkSession
    with open(ranks, "rb") as f:
        rank_file = spark.sparkContext.broadcast(f.read())  # one vocabulary
    schema = StructType([*df.schema.fields, *(StructField(c, BinaryType()) for c in added)])

    def sliced(codec, batch):
        for rows, values in batch_slices(batch, column):
            made = work(codec, values)
            yield pa.RecordBatch.from_arrays([*rows.columns, *(m.cast(pa.binary()) for m in made)], names=[*batch.schema.names, *added])

    def batches(parts):
        codec = _codec(rank_file.value, pattern)
        for batch in parts:
            yield from sliced(codec, batch)
            given_back()
        codec.forget()

    return df.mapInArrow(tidy(batches), schema)


def encoded(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of the text, as little-endian unsigned 32-bit integers."""
    return _mapped(docs, ranks, pattern, text, [ids], lambda codec, texts: codec.encode_columns(texts))


def decoded(df: DataFrame, ranks: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes of the ids; null ids count as none."""
    return _mapped(df, ranks, pattern, ids, [into], lambda codec, given: [codec.decode_column(given)])


def round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the ids and what they decode to, in one pass over the texts."""
    return _mapped(docs, ranks, pattern, text, [ids, into], lambda codec, texts: codec.encode_columns(texts, back=True))
