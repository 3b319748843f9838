"""Set-similarity join on word n-grams by PartEnum signatures.

Sets are dealt to bands of size; similar sets lie in one band or in neighbouring ones.  Within a pair of bands similar sets differ in at most k
elements.  The domain of elements is cut into (k + 1) / 2 parts: in one of them the sets differ in at most one element.  Each part is cut in three: two
of the thirds are then equal.  So a set's signatures are, for each part, the contents of two of its three thirds, and similar sets share one.

Two empty thirds say little, and many sets would share them.  So there are a few parts more than needed: similar sets agree in more parts than one, and a
set with no more thin parts than that (parts with two empty thirds) leaves their signatures out, as one of the agreeing parts has others.

Sets that share a signature are candidates and are compared exactly, first each with the smallest document it shares one with.  That connects almost all that are similar.  Where
a signature's documents are still in several components, it is joined with other such signatures of the same first document, and the documents outside the
largest component are compared with all the others, block by block: no task holds more than two blocks, and every two candidates are compared or connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.arrays import LOWER, Chunk, chunks, mix, ngrams, word_hashes, words
from opinara.llm.blobs import joined, packed
from opinara.llm.components import components
from opinara.llm.durable import stored, text_bytes, written

BUCKET_BYTES = 4 << 20  # text for each bucket of signatures
CHUNK = 1 << 20
BLOCK = 512  # sets on either side that are compared at once
SIGNATURE = (1 << 40) - 1  # kept bits; equal ones by chance only cost a comparison


def shingles(chunk: Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every row: (row, hash), sorted.  Fewer words than ``size`` are one shingle."""
    lower = LOWER[chunk.data]
    found = words(chunk)
    hashes = word_hashes(lower, found.start, found.end)
    grams, at = ngrams(hashes, found.row, size)
    row = found.row[at]
    first = found.first_of(len(chunk))
    count = np.diff(first)
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        own = np.zeros(len(few), np.uint64)
        for j in range(size - 1):
            has = count[few] > j
            own[has] = mix(own[has] + hashes[first[few[has]] + j] + np.uint64(j + 1))
        grams, row = np.concatenate([grams, own]), np.concatenate([row, few])
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    return row[new], grams[new]


class Bands:
    """Size bands for a similarity of ``percent``, and the parts that each needs."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.low, self.parts = [1], []
        self.spare: list[int] = []  # parts beyond those needed for one to differ in at most one element

    def grow(self, largest: int) -> None:
        p = self.percent
        while not self.parts or self.low[-1] <= largest:
            high = self.low[-1] * 100 // p
            differ = (high + high * 100 // p) * (100 - p) // (100 + p)
            parts = (differ + 2) // 2
            self.spare.append(2 + parts // 20)
            self.parts.append(parts + self.spare[-1] if differ else 0)  # 0: the sets are equal
            self.low.append(high + 1)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        self.grow(int(sizes.max(initial=1)))
        return np.searchsorted(self.low, sizes, "right") - 1


def signatures(row: np.ndarray, grams: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of the sets of a chunk; a set gets those of its own band and of the one below."""
    out_row, out = [], []
    band = bands.of(sizes)
    parts_of, spare_of = np.array(bands.parts, np.int64), np.array(bands.spare, np.int64)
    third = (mix(grams ^ np.uint64(0x51)) % np.uint64(3)).astype(np.int64)
    spot = mix(grams ^ np.uint64(0xA7)) >> np.uint64(32)
    value = mix(grams ^ np.uint64(0x3D))
    for lower in (0, 1):
        tag = band - lower
        used = (sizes > 0) & (tag >= 0)
        parts = np.where(used, np.maximum(parts_of[np.maximum(tag, 0)], 1), 0)
        whole = parts_of[np.maximum(tag, 0)] == 0
        base = np.cumsum(parts) - parts
        keep = used[row]
        r = row[keep]
        cell = base[r] + ((spot[keep] * parts[r].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros((int(parts.sum()), 3), np.uint64)
        np.add.at(sums.reshape(-1), cell * 3 + third[keep], value[keep])
        owner = np.repeat(np.arange(len(sizes)), parts)
        number = np.arange(len(owner)) - base[owner]
        filled = np.bincount(cell * 3 + third[keep], minlength=len(owner) * 3).reshape(-1, 3)
        filled = filled.sum(1, keepdims=True) - filled > 0
        thin = np.bincount(owner[~filled.all(1)], minlength=len(sizes))
        drop = (thin <= spare_of[np.maximum(tag, 0)])[owner]  # this set has a part that agrees and isn't thin
        total = sums.sum(1, dtype=np.uint64)
        for e in range(3):
            some = ~(drop & ~filled[:, e]) & ~whole[owner] | whole[owner] & (e == 0)
            kept = np.where(whole[owner], total, total - sums[:, e])[some]
            place = mix((tag[owner] * 1_000_003 + number * 4 + e)[some].astype(np.uint64))
            out_row.append(owner[some])
            out.append(mix(kept + place))
    return np.concatenate(out_row), np.concatenate(out)


def _send(size: int, percent: int, buckets: int):
    names = ["bucket", "signature", "doc", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            all_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column(1), CHUNK):
                ids = all_ids[chunk.first : chunk.first + len(chunk)]
                row, grams = shingles(chunk, size)
                first = np.searchsorted(row, np.arange(len(chunk) + 1))
                sizes = np.diff(first)
                held: dict[bytes, int] = {}
                a, b, own = [], [], sizes > 0
                for i in np.argsort(ids, kind="stable").tolist():  # equal sets: the smallest id stands for them, the others link to it
                    at = held.setdefault(grams[first[i] : first[i + 1]].tobytes(), i) if own[i] else i
                    if at != i:
                        own[i] = False
                        a.append(int(ids[at]))
                        b.append(int(ids[i]))
                keep = own[row]
                owner, found = signatures(row[keep], grams[keep], np.where(own, sizes, 0), bands)
                doc = ids[owner]
                bucket = ((found >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
                found = (found & np.uint64(SIGNATURE)).astype(np.int64)
                by = np.lexsort((doc, bucket))
                out = [np.zeros(0, np.int64)] if not len(by) else np.split(by, np.flatnonzero(np.diff(bucket[by])) + 1)
                out = [rows for rows in out if len(rows)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(bucket[rows[0]]) for rows in out] + [None] * len(a), pa.int64()),
                        pa.array([packed(found[rows]) for rows in out] + [None] * len(a), pa.binary()),
                        pa.array([packed(doc[rows], True) for rows in out] + [None] * len(a), pa.binary()),
                        pa.array([None] * len(out) + a, pa.int64()),
                        pa.array([None] * len(out) + b, pa.int64()),
                    ],
                    names=names,
                )

    return run, "bucket long, signature binary, doc binary, a long, b long"


def _groups(table: pa.Table) -> pa.Table:
    """Documents of one bucket that share signatures: group, its first document, document.  Groups of equal members are one.

    Rows without a bucket are links found by the sender: they pass as groups of two with the number 0.
    """
    if table.column("bucket")[0].as_py() is None:
        a, b = table.column("a"), table.column("b")
        return pa.table({"grp": pa.array(np.zeros(len(table), np.int64)), "size": pa.array(np.zeros(len(table), np.int64)), "pivot": a, "doc": b})
    found, doc = joined(table, "signature"), joined(table, "doc", True)
    order = np.lexsort((doc, found))
    found, doc = found[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    found, doc = found[new], doc[new]
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(found)))
    first, size = first[size > 1], size[size > 1]
    if not len(first):
        return pa.table({c: pa.array([], pa.int64()) for c in ("grp", "size", "pivot", "doc")})
    member = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    mark = np.add.reduceat(mix(doc[member].astype(np.uint64)), np.cumsum(size) - size)
    _, chosen = np.unique(mark, return_index=True)
    first, size, mark = first[chosen], size[chosen], mark[chosen]
    member = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
    return pa.table(
        {
            "grp": pa.array(np.repeat(mark.astype(np.int64), size)),
            "size": pa.array(np.repeat(size, size)),
            "pivot": pa.array(np.repeat(doc[first], size)),
            "doc": pa.array(doc[member]),
        }
    )


class Shared:
    """Sizes of the intersections of sets with each of ``others``, whose elements are sorted once."""

    def __init__(self, others: list[np.ndarray]) -> None:
        whole = np.concatenate([np.zeros(0, np.uint64), *others])
        order = np.argsort(whole, kind="stable")
        self.whole, self.owner, self.number = whole[order], np.repeat(np.arange(len(others)), [len(x) for x in others])[order], len(others)

    def counts(self, own: np.ndarray) -> np.ndarray:
        begin = np.searchsorted(self.whole, own)
        n = np.searchsorted(self.whole, own, "right") - begin
        return np.bincount(self.owner[np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=self.number)


Row = tuple[int, int, np.ndarray]  # document, label, shingles


def _links(left: list[Row], right: list[Row], percent: int) -> Iterator[tuple[int, int]]:
    """Similar pairs of different labels; of each document on the left one pair for each label."""
    if not left or not right:
        return
    sizes, shared = np.array([len(r[2]) for r in right]), Shared([r[2] for r in right])
    for doc, label, own in left:
        both = shared.counts(own)
        met: set[int] = set()
        for j in np.flatnonzero((both > 0) & (100 * both >= percent * (len(own) + sizes - both))).tolist():
            other, its, _ = right[j]
            if its != label and other != doc and its not in met:
                met.add(its)
                yield doc, other


def _match(size: int, percent: int):
    """Links of each block, whose rows follow one another, those of the left first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sides = None, ([], [])

        def found() -> pa.RecordBatch:
            pairs = list(_links(*sides, percent))
            return pa.RecordBatch.from_arrays([pa.array([p[j] for p in pairs], pa.int64()) for j in (0, 1)], names=["a", "b"])

        for batch in batches:
            rows = list(zip(*(batch.column(j).to_pylist() for j in range(6)), strict=True))
            for chunk in chunks(batch.column(6), CHUNK):
                owner, grams = shingles(chunk, size)
                first = np.searchsorted(owner, np.arange(len(chunk) + 1))
                for n, (g, i, j, side, doc, label) in enumerate(rows[chunk.first : chunk.first + len(chunk)]):
                    if (g, i, j) != block:
                        if block:
                            yield found()
                        block, sides = (g, i, j), ([], [])
                    sides[side].append((doc, label, grams[first[n] : first[n + 1]].copy()))
        if block:
            yield found()

    return run


def _compared(texts: DataFrame, left: DataFrame, right: DataFrame, size: int, percent: int, keep: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Links between the documents of the same group ``g`` on the left and on the right, (g, doc, label) each, and the texts of these and of the documents ``keep``.

    Texts meet their documents once, by document, and are kept with their blocks: neither the comparison nor a
    later one of some of the same documents goes back to all texts.
    """

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    numbers = blocks(left, "rows").join(blocks(right, "columns"), "g")
    spot = F.xxhash64("doc")
    one = left.join(numbers, "g").select(
        "g", F.pmod(spot, F.col("rows")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"), F.lit(0).alias("side"), "doc", "label"
    )
    other = right.join(numbers, "g").select(
        "g", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), F.pmod(spot, F.col("columns")).cast("int").alias("j"), F.lit(1).alias("side"), "doc", "label"
    )
    # a document's blocks in one row: its text is met, and kept, once
    dealt = one.unionByName(other).select("doc", F.struct("g", "i", "j", "side", "label").alias("place"))
    dealt = dealt if keep is None else dealt.unionByName(keep.select("doc"), allowMissingColumns=True)
    members = dealt.groupBy("doc").agg(F.collect_list("place").alias("places"))
    # texts take a third of the room of their shingles' hashes, so they travel and are cut where they arrive
    met = written(texts.join(members.hint("merge"), "doc"))
    rows = met.select("doc", "text", F.inline("places")).select("g", "i", "j", "side", "doc", "label", "text")
    links = rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "side").mapInArrow(_match(size, percent), "a long, b long")
    return links, met.select("doc", "text")


def set_sizes(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), CHUNK):
                row, _ = shingles(chunk, size)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, len(chunk)), pa.array(np.bincount(row, minlength=len(chunk)))], names=[key, "n_shingles"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_shingles long")


def similar_links(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect all similar documents, and the components (node, label) they make."""
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    buckets = max(8, text_bytes(texts) // BUCKET_BYTES)
    run, schema = _send(shingle, percent, buckets)
    routed = texts.mapInArrow(run, schema).withColumn("target", F.coalesce("bucket", -1 - F.pmod("b", F.lit(buckets))))
    groups = written(routed.groupBy("target").applyInArrow(_groups, "grp long, size long, pivot long, doc long").distinct())
    tested = groups.where("size > 0 and pivot <> doc").groupBy("doc").agg(F.min("pivot").alias("pivot"))
    rest = tested.select(F.col("pivot").alias("g"), "doc", F.col("doc").alias("label"))
    first = rest.select("g", F.col("g").alias("doc"), F.col("g").alias("label")).distinct()
    equal = groups.where("size = 0").select(F.col("pivot").alias("a"), F.col("doc").alias("b"))
    found, met = _compared(texts, first, rest, shingle, percent, keep=groups.where("size > 0").select("doc").distinct())
    links = stored(equal.unionByName(found).distinct())
    labels = components(links)

    # documents of a signature that are still in several components
    pairs = groups.where("size = 2 and pivot <> doc").join(tested, ["doc", "pivot"], "left_anti").select("grp").distinct()
    asked = groups.where("size > 2").unionByName(groups.where("size = 2").join(pairs, "grp", "left_semi").select(*groups.columns))
    member = asked.join(labels, F.col("doc") == F.col("node"), "left").select("grp", "pivot", "doc", F.coalesce("label", "doc").alias("label"))
    apart = member.groupBy("grp").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("grp")
    apart = stored(member.join(apart, "grp", "left_semi").select("pivot", "doc", "label").distinct())
    if apart.isEmpty():
        return links, labels
    # signatures with the same first document are one group, so a document travels once and not with each of them
    whole = apart.withColumnRenamed("pivot", "g")
    largest = whole.groupBy("g", "label").count().groupBy("g").agg(F.max_by("label", F.struct("count", "label")).alias("largest"))
    mixed = stored(whole.join(largest, "g"))
    right = mixed.select("g", "doc", "label")
    left = mixed.where("label <> largest").select("g", "doc", "label")
    found, _ = _compared(met, left, right, shingle, percent)
    links = stored(links.unionByName(found).distinct())
    return links, components(links)


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per document: its key, n_shingles and component_id, the smallest key reachable by links of ``percent`` similarity.

    A null text, or one without words, has no shingles and no links.  Rows with a null key take no part and have a null component; rows that repeat a key
    are one document, linked by any of them.  Other columns are not read.
    """
    _, labels = similar_links(docs, key, text, shingle, percent)
    sizes = set_sizes(docs, key, text, shingle)
    return sizes.join(labels, F.col(key).cast("long") == F.col("node"), "left").select(key, "n_shingles", F.coalesce("label", F.col(key).cast("long")).alias("component_id"))
