"""Suffix-array dedup: exact removal of repeated byte strings by interval expansion on a Burrows-Wheeler transform.

The strings of ``length`` bytes are dealt to buckets by their minimizer, the smallest hash of their short substrings: equal strings meet in
one bucket, and neighbouring strings with one minimizer travel as one segment.  A task sends equal segments once, for the smallest document that
has them, and marks them in its other documents straight away.

In a bucket, segments with repeats are joined to one text, whose transform is expanded backwards, breadth first: all intervals of
substrings of length 1, 2, 3 ... An interval's end that is new at length n is a place where neighbouring suffixes share n - 1 bytes.  Each place is found once,
by increasing value, and the expansion stops at the minimum length.  Places not found then lie within groups of suffixes that share ``length`` bytes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.arrays import Chunk, chunks, gram_hashes, mix, run_hashes, sliding_min
from opinara.llm.blobs import joined, packed, unpacked
from opinara.llm.durable import text_bytes

LENGTH = 50
SEED = 12
GAP = 0xFF  # no byte of UTF-8
LAST = np.iinfo(np.int64).max
BUCKET_BYTES = 2 << 20  # text for each bucket; its segments are about three times that
SEND_BYTES = 2 << 20  # text whose segments a task compares before it sends them
GROUP_BYTES = 8 << 20  # text put together again at once


def segments(chunk: Chunk, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, minimizer) of the segments of a chunk: runs of strings of one row with the same minimizer."""
    data, bounds = chunk.data, chunk.bounds
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    least = sliding_min(gram_hashes(data, seed), length - seed + 1)
    fits = np.zeros(len(data) + 1, np.int8)
    long = np.diff(bounds) >= length
    np.add.at(fits, bounds[:-1][long], 1)
    np.add.at(fits, bounds[1:][long] - length + 1, -1)
    fits = np.cumsum(fits[: len(least)], dtype=np.int8) > 0
    new = fits.copy()
    new[1:] &= ~fits[:-1] | (least[1:] != least[:-1])
    end = fits.copy()
    end[:-1] &= ~fits[1:] | (least[1:] != least[:-1])
    start = np.flatnonzero(new)
    return start, np.flatnonzero(end) + length, least[start]


MARKS = "part long, doc binary, crc binary, start binary, stop binary"


def _marks(doc: np.ndarray, crc: np.ndarray, start: np.ndarray, stop: np.ndarray, parts: int) -> Iterator[dict]:
    """Removed runs as one row for each part of the documents."""
    part = (mix(doc.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((start, doc, part))
    part = part[order]
    for rows in np.split(order, np.flatnonzero(np.diff(part)) + 1) if len(order) else ():
        yield {"part": int(mix(doc[rows[:1]].astype(np.uint64))[0] % np.uint64(parts)), "doc": packed(doc[rows], True), "crc": packed(crc[rows]), "start": packed(start[rows]), "stop": packed(stop[rows])}


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array([r.get(n) for r in rows], pa.int64() if n in ("bucket", "part") else pa.binary()) for n in names})


def _send(length: int, seed: int, buckets: int, parts: int, own_keys: bool):
    names = ["bucket", "text", "doc", "crc", "start", "size", "part", "stop"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            ids = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            for chunk in chunks(batch.column(1).take(pa.array(order)), SEND_BYTES):
                start, end, least = segments(chunk, length, seed)
                if not len(start):
                    continue
                row = np.searchsorted(chunk.bounds, start, "right") - 1
                doc = ids[chunk.first + row]
                crcs = np.array([0 if own_keys else zlib.crc32(chunk.raw(i)) for i in range(len(chunk))], np.int64)
                held: dict[bytes, int] = {}  # segment -> the smallest document of the chunk that has it
                whole = chunk.data.tobytes()
                texts = [whole[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                here = np.array([held.setdefault(t, d) for t, d in zip(texts, doc.tolist(), strict=True)], np.int64) < doc
                at = start - chunk.bounds[row]
                size = end - start
                out = list(_marks(doc[here], crcs[row[here]], at[here], (at + size)[here], parts))
                bucket = (mix(least) % np.uint64(buckets)).astype(np.int64)
                bucket[here] = -1
                by = np.argsort(bucket, kind="stable")
                for rows in np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1):
                    if bucket[rows[0]] >= 0:
                        out.append({"bucket": int(bucket[rows[0]]), "text": squeeze(b"".join([texts[i] for i in rows])), "doc": packed(doc[rows], True), "crc": packed(crcs[row[rows]]), "start": packed(at[rows]), "size": packed(size[rows])})
                yield _batch(out, names)

    return run, "bucket long, text binary, doc binary, crc binary, start binary, size binary, part long, stop binary"


def rotations(text: np.ndarray, depth: int) -> np.ndarray:
    """The rotations of ``text`` in the order of their first ``depth`` bytes at least, by prefix doubling."""
    n = len(text)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | np.roll(text, -j).astype(np.uint64)
    known = 8
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]])).astype(np.uint64)
        if known >= depth:
            return order
        key = rank * np.uint64(n) + np.roll(rank, -known)
        known *= 2


def shared_prefixes(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """``out[i]``: whether rotations order[i - 1] and order[i] share fewer than ``least`` bytes, by expansion of intervals.

    ``out[0]`` is true.  ``order`` need only sort by the first ``least`` bytes.
    """
    n = len(text)
    before = text[order - 1]  # the transform
    back = np.empty(n, np.int64)  # where the rotation that starts one byte earlier stands
    back[np.argsort(before, kind="stable")] = np.arange(n)
    first = np.sort(text)
    found = np.zeros(n + 1, bool)
    found[0] = found[n] = True
    low, high = np.array([0]), np.array([n])
    for turn in range(least):
        size = high - low
        owner = np.repeat(np.arange(len(low)), size)
        inside = np.arange(size.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        place = back[inside]
        by = np.argsort(place, kind="stable") if len(place) < n // 8 else None
        if by is None:
            owned = np.full(n, -1)
            owned[place] = owner
            place = np.flatnonzero(owned >= 0)
            owner = owned[place]
        else:
            place, owner = place[by], owner[by]
        new = np.ones(len(place) + 1, bool)
        new[1:-1] = (place[1:] != place[:-1] + 1) | (owner[1:] != owner[:-1]) | (first[place[1:]] != first[place[:-1]])
        starts = place[np.flatnonzero(new[:-1])]
        ends = place[np.flatnonzero(new[1:])] + 1
        # an end reached before has its neighbours' common prefix already
        fresh = ~found[ends]
        if turn == 0:
            fresh |= ends == n
        found[ends] = True
        low, high = starts[fresh], ends[fresh]
        if not len(low):
            break
    return found[:n]


def repeated(text: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the strings of ``length`` bytes in segments of ``text``: (segment, offset) of those that a smaller document has too."""
    fits = np.zeros(len(text) + 1, np.int8)
    fits[start] += 1
    fits[start + size - length + 1] -= 1
    fits = np.flatnonzero(np.cumsum(fits[:-1], dtype=np.int8)[: max(len(text) - length + 1, 0)])
    hashes = gram_hashes(text, length)[fits]
    by = np.argsort(hashes)
    ordered = hashes[by]
    del hashes
    same = ordered[1:] == ordered[:-1]
    del ordered
    again = np.zeros(len(by), bool)  # its hash comes again: only these can be repeats
    again[by[1:][same]] = True
    again[by[:-1][same]] = True
    del by, same
    fits = fits[again]
    if not len(fits):
        return fits, fits
    owner = np.searchsorted(start, fits, "right") - 1
    offset = fits - start[owner]
    cut = np.flatnonzero((np.diff(fits) != 1) | (np.diff(owner) != 0)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(fits) - 1]])
    spans = offset[last] - offset[first] + length
    places = np.arange((spans + 1).sum()) - np.repeat(np.cumsum(spans + 1) - spans - 1, spans + 1)
    piece = np.repeat(np.arange(len(first)), spans + 1)
    real = places < spans[piece]
    joined_text = np.full(len(places), GAP, np.uint8)
    joined_text[real] = text[(start[owner[first]] + offset[first])[piece[real]] + places[real]]

    order = rotations(joined_text, length)
    new = shared_prefixes(joined_text, order, length)
    whole = places <= spans[piece] - length
    documents = np.where(whole, doc[owner[first]][piece], LAST)[order]
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(documents, np.flatnonzero(new))[group]
    gone = order[whole[order] & (documents > least)]
    return owner[first][piece[gone]], offset[first][piece[gone]] + places[gone]


def _search(length: int, parts: int):
    def run(table: pa.Table) -> pa.Table:
        doc, crc, start, size = (joined(table, c, c == "doc") for c in ("doc", "crc", "start", "size"))
        text = np.frombuffer(b"".join(map(zstandard.decompress, table.column("text").to_pylist())), np.uint8)
        at = np.cumsum(size) - size
        # equal segments: one stands for all, with the smallest document
        names = run_hashes(text, np.append(at, len(text)))
        order = np.lexsort((doc, size, names))
        names = names[order]
        new = np.concatenate([[True], (names[1:] != names[:-1]) | (np.diff(size[order]) != 0)])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        chosen = order[new]
        smallest = doc[chosen][group]
        chosen = np.sort(chosen)
        number = np.empty(len(chosen), np.int64)
        number[group[chosen]] = np.arange(len(chosen))
        group = number[group]
        if len(chosen) < len(doc):
            text = np.concatenate([text[a:b] for a, b in zip(at[chosen].tolist(), (at + size)[chosen].tolist(), strict=True)])
        segment, offset = repeated(text, np.cumsum(size[chosen]) - size[chosen], size[chosen], doc[chosen], length)
        out = [(doc[r], crc[r], start[r], start[r] + size[r]) for r in (np.flatnonzero(doc > smallest),)]
        # runs of removed strings, in every row that the segment stands for
        by = np.lexsort((offset, segment))
        segment, offset = segment[by], offset[by]
        if len(segment):
            cut = np.concatenate([[True], (np.diff(segment) != 0) | (np.diff(offset) != 1)])
            stop = offset[np.concatenate([cut[1:], [True]])] + length
            segment, offset = segment[cut], offset[cut]
            holders = np.flatnonzero(doc == smallest)
            holders = holders[np.argsort(group[holders], kind="stable")]
            lo, hi = np.searchsorted(group[holders], segment), np.searchsorted(group[holders], segment, "right")
            run_no = np.repeat(np.arange(len(segment)), hi - lo)
            row = holders[np.arange(len(run_no)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[run_no]]
            out.append((doc[row], crc[row], start[row] + offset[run_no], start[row] + stop[run_no]))
        rows = list(_marks(*(np.concatenate([o[j] for o in out]) for j in range(4)), parts))
        return pa.table({"part": pa.array([r["part"] for r in rows], pa.int64()), **{c: pa.array([r[c] for r in rows], pa.binary()) for c in ("doc", "crc", "start", "stop")}})

    return run


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of intervals that overlap or touch."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], start[1:] > stop[:-1]])
    return start[new], stop[np.concatenate([new[1:], [True]])]


def _finish(key: str, with_text: bool, own_keys: bool):
    def run(texts: pa.Table, marks: pa.Table) -> pa.Table:
        doc, crc, start, stop = (joined(marks, c, c == "doc") for c in ("doc", "crc", "start", "stop"))
        order = np.lexsort((crc, doc))
        doc, crc, start, stop = doc[order], crc[order], start[order], stop[order]
        out: dict[str, list] = {c: [] for c in ("key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for ids, sizes, blob in zip(*(texts.column(c).to_pylist() for c in ("ids", "sizes", "texts")), strict=True):
            whole, at = zstandard.decompress(blob), 0
            for own, size in zip(unpacked(ids).tolist(), unpacked(sizes).tolist(), strict=True):
                raw = whole[at : at + size]
                at += size
                lo, hi = np.searchsorted(doc, own), np.searchsorted(doc, own, "right")
                rows = np.arange(lo, hi)
                if hi > lo and not own_keys:
                    rows = rows[crc[lo:hi] == zlib.crc32(raw)]
                kept, gone, spans = raw, 0, 0
                if len(rows):
                    a, b = merged(start[rows], stop[rows])
                    gone, spans = int((b - a).sum()), len(a)
                    edges = [0, *np.stack([a, b], 1).ravel().tolist(), len(raw)]
                    kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                row = (None if own == LAST else own, len(raw), gone, spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None)
                for name, x in zip(out, row, strict=True):
                    out[name].append(x)
        kinds = {"kept_sha256": pa.string(), "kept": pa.string()}
        return pa.table({key if c == "key" else c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items() if with_text or c != "kept"})

    return run


def _dealt(parts: int):
    """Texts of a part of the documents, some together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            ids = batch.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(1), 4 * SEND_BYTES):
                own = ids[chunk.first : chunk.first + len(chunk)]
                part = (mix(own.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
                by = np.argsort(part, kind="stable")
                groups = np.split(by, np.flatnonzero(np.diff(part[by])) + 1)
                sizes = np.diff(chunk.bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(part[g[0]]) for g in groups]),
                        pa.array([packed(own[g]) for g in groups], pa.binary()),
                        pa.array([packed(sizes[g]) for g in groups], pa.binary()),
                        pa.array([squeeze(b"".join([chunk.raw(i) for i in g])) for g in groups], pa.binary()),
                    ],
                    names=["part", "ids", "sizes", "texts"],
                )

    return run, "part long, ids binary, sizes binary, texts binary"


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Per document: n_bytes, and n_removed, n_spans and kept_sha256 after removal of each byte in a string of ``length`` bytes
    that also starts in a document with a smaller key; ``with_text`` adds what is kept (a character cut apart is left out).

    A null or empty text has nothing to remove.  A null key comes after all others; rows of one key are not smaller than each other
    and are judged each.  (The largest long comes back as null.)  Other columns are not read.
    """
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    total = text_bytes(docs)
    buckets, parts = max(8, total // BUCKET_BYTES), max(8, total // GROUP_BYTES)
    seed = min(SEED, max(1, length // 2))
    own_keys = docs.groupBy(key).count().where("count > 1").isEmpty()  # else rows of one key are told apart by their texts' crc32
    sent = docs.mapInArrow(*_send(length, seed, buckets, parts, own_keys)).withColumn("target", F.coalesce("bucket", -1 - F.col("part")))
    marks = sent.groupBy("target").applyInArrow(_route(_search(length, parts)), MARKS)
    kind = f"`{key}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept string" if with_text else "")
    texts = docs.mapInArrow(*_dealt(parts))
    return texts.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(_finish(key, with_text, own_keys), kind)


def _route(search):
    """Segments of a bucket are searched; marks made by the sender pass on."""

    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() is None:
            return table.select(["part", "doc", "crc", "start", "stop"])
        return search(table)

    return run
