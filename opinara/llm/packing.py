"""Best-fit packing of token sequences by minimum bin slack.

Only lengths matter for packing, and there are at most ``capacity`` of them, whatever the corpus size.  So documents are tokenised and cut
where they lie, a table of lengths is counted, and the plan is made on that table: for each bin, the longest remaining
length plus the fullest feasible combination of the others, found by subset sums on a bitset.  A combination is used as
often as the counts allow.  The plan says which ranks of a length go where; each piece then looks up its place by its rank.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinara.llm.durable import stored

CAPACITY = 2048
END = b"\0\0\0\0"
CACHE = 300_000  # words whose ids a task remembers
SPECIAL = "<|endoftext|>"
#: A space between two white spaces, or after one at the end: here the parts between spaces don't stand alone.
_JOINED = re.compile(r"\s (?:\s|\Z)")


class Encoder(dict):
    """Ids of texts as little-endian 32-bit words, by the byte-level vocabulary in ``path``.

    Its pre-tokenizer never lets a token cross the space before a word, so the ids of a text are those of its space-led
    parts, which repeat.  The dictionary holds them by part.
    """

    def __init__(self, path: str, ranks: str) -> None:
        import base64

        import public_tokenizers
        import tiktoken

        self.path, self.whole = path, None
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(ranks, "rb"))}
        self.parts = tiktoken.Encoding("parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> bytes:
        return array("I", self.parts.encode_ordinary(text)).tobytes()

    def __missing__(self, part: str) -> bytes:
        found = self[part] = self.ids(" " + part)
        return found

    def encode(self, text: str) -> bytes:
        if SPECIAL in text:  # one id of its own
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if _JOINED.search(text):
            return self.ids(text)
        first, *rest = text.split(" ")
        out = self.ids(first) + b"".join(map(self.__getitem__, rest))
        if len(self) > CACHE:
            self.clear()
        return out


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, ranks: str) -> Encoder:
    """One per worker process."""
    if (path, ranks) not in _encoders:
        _encoders[path, ranks] = Encoder(path, ranks)
    return _encoders[path, ranks]


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: full ones, only the first may be shorter."""
    head = length % capacity or capacity
    return [(0, min(head, length)), *((at, capacity) for at in range(head, length, capacity))]


def token_pieces(docs: DataFrame, path: str, ranks: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document: its key, piece, start, length, ids_crc32."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, ranks).encode
        for batch in batches:
            row, rows = [], []
            for i, value in enumerate(batch.column(1)):
                ids = encode(value.as_py() or "") + END
                for piece, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    row.append(i)
                    rows.append((piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            table = np.array(rows, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(table[:, 0].astype(np.int32)), *(pa.array(table[:, j]) for j in (1, 2, 3))],
                names=[key, "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long")


def fullest(room: int, counts: dict[int, int], lengths: list[int]) -> list[tuple[int, int]]:
    """The combination of lengths, within their counts, that fills ``room`` best, longer ones first: (length, times)."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        left, part = min(counts[length], room // length), 1
        while left > 0:
            part = min(part, left)
            steps.append((reach, length, part))
            reach |= (reach << (length * part)) & mask
            left -= part
            part *= 2
            if reach >> room:
                break
        if reach >> room:
            break
    at = reach.bit_length() - 1
    used: dict[int, int] = {}
    for before, length, part in reversed(steps):
        if not before >> at & 1:
            at -= length * part
            used[length] = used.get(length, 0) + part
    return list(used.items())


def bins(counts: dict[int, int], capacity: int) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """Minimum bin slack on a table of lengths: combinations and how many bins take each."""
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left, reverse=True)
    while lengths:
        longest = lengths[0]
        left[longest] -= 1
        combination = dict(fullest(capacity - longest, left, lengths))
        left[longest] += 1
        combination[longest] = combination.get(longest, 0) + 1
        times = min(left[n] // m for n, m in combination.items())
        for n, m in combination.items():
            left[n] -= m * times
        yield sorted(combination.items(), reverse=True), times
        if any(left[n] == 0 for n in combination):
            lengths = [n for n in lengths if left[n]]


@dataclass
class Plan:
    """For each length: from which rank on, which bin first, how many in a bin, and where in the bin."""

    table: dict[int, np.ndarray]
    sequences: int

    def place(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = self.table[length]
        at = rows[np.searchsorted(rows[:, 0], rank, "right") - 1]
        step = rank - at[:, 0]
        return at[:, 1] + step // at[:, 2], at[:, 3] + step % at[:, 2] * length


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = dict.fromkeys(counts, 0)
    sequence = 0
    for combination, times in bins(counts, capacity):
        offset = 0
        for length, each in combination:
            rows.setdefault(length, []).append((used[length], sequence, each, offset))
            used[length] += each * times
            offset += each * length
        sequence += times
    return Plan({n: np.array(r, np.int64) for n, r in rows.items()}, sequence)


def pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, shards: int = 128) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens.

    What the driver gets is a count for each length and shard, at most ``capacity * shards`` numbers.
    """
    spread = stored(pieces.withColumn("shard", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(shards)).cast("int")))
    before = np.zeros((capacity + 1, shards + 1), np.int64)
    for r in spread.groupBy("length", "shard").count().collect():
        before[r["length"], r["shard"] + 1] = r["count"]
    before = before.cumsum(1)
    made = plan({n: int(c) for n, c in enumerate(before[:, -1]) if c}, capacity)
    schema = spread.drop("shard").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, shard, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "shard", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                sequence[at], offset[at] = made.place(int(n), before[n, shard[at]] + rank[at] - 1)
            own = [batch.column(batch.schema.get_field_index(c)) for c in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*own, pa.array(sequence), pa.array(offset)], names=schema.names)

    order = W.partitionBy("length", "shard").orderBy(key, "piece", "start", "ids_crc32")
    return spread.withColumn("rank", F.row_number().over(order).cast("long")).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, ranks: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack all documents.

    A null or empty text is the end token alone.  Rows that repeat a key or have none are packed each on its own;
    pieces of equal rows are interchangeable.  Other columns are not read.
    """
    return pack(token_pieces(docs, path, ranks, key, text, capacity), key, capacity)
