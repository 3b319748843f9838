"""Language-model scoring with Brown classes.

Exchange clustering moves frequent words between classes to raise the likelihood of a class bigram model; a text's probability is
then the product of class transitions and of word emissions within the classes.

Counts cover all training tokens.  The ``head`` most frequent words are sent to all tasks; any other word belongs to a class given by its
shape, so its class is known where it stands, and its count comes by a join.  All tables that are sent about are bounded by the parameters:
``head`` words, ``head * classes`` neighbour counts, ``classes**3`` transitions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from opinara.llm.durable import stored, written

END = 0  # class of the end token; class of what stands before a text
SHAPES = 8  # classes 1 to 8: words outside the head, by shape
FLUSH = 400_000  # distinct words a task holds before it hands on their counts
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_IS_PUNCTUATION = frozenset(_PUNCTUATION)


def tokens(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lowered, in bytes.  bytes.split and bytes.lower know just the ASCII spaces and letters that are meant."""
    return (text or "").encode().lower().split()


def shape(word: bytes) -> int:
    return 1 + (len(word) > 10) + 2 * (not word.isascii()) + 4 * (word[-1] in _IS_PUNCTUATION)


def shape_column(word: str) -> Column:
    """``shape`` in SQL, for a binary column."""
    text = F.col(word).cast("string")
    return (
        1
        + (F.octet_length(word) > 10).cast("int")
        + 2 * (F.octet_length(word) != F.length(text)).cast("int")
        + 4 * F.ascii(F.substring(text, -1, 1)).isin(list(_PUNCTUATION)).cast("int")
    )


def held_out(key: str) -> Column:
    """True for keys whose crc32, as text, is divisible by 10; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """word (binary), n: how often each word occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for value in batch.column(0):
                counts.update(tokens(value.as_py()))
                if len(counts) > FLUSH:
                    yield flushed()
        yield flushed()

    return docs.select(text).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Head:
    """The most frequent words, most frequent first, and the class of each."""

    words: list[bytes]
    counts: np.ndarray
    classes: np.ndarray
    n_classes: int

    def index(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}

    def ids(self, index: dict[bytes, int], found: list[bytes]) -> np.ndarray:
        """Head numbers of words; others get ``len(words) + shape``."""
        out = np.fromiter(map(index.get, found, repeat(-1)), np.int64, len(found))
        rare = np.flatnonzero(out < 0)
        out[rare] = [len(self.words) + shape(found[i]) for i in rare.tolist()]
        return out

    def class_table(self) -> np.ndarray:
        """Class by number, the shapes' after the words'."""
        return np.concatenate([self.classes, np.arange(SHAPES + 1)])


def numbered(docs: DataFrame, head: Head) -> DataFrame:
    """The numbers of each text's tokens (``Head.ids``) as bytes, kept in the shared folder: all passes but the first read these and not the texts."""
    kind = number_type(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = head.index()
        for batch in batches:
            out = [head.ids(index, tokens(value.as_py())).astype(kind).tobytes() for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["numbers"])

    return written(docs.mapInArrow(run, "numbers binary"))


def number_type(head: Head) -> np.dtype:
    return np.min_scalar_type(len(head.words) + SHAPES)


PARTS = 64  # pieces in which a task hands on a table of counts


def _summed(numbers: DataFrame, size: int, kind: np.dtype, count) -> np.ndarray:
    """Sum over all tasks of a table with ``size`` numbers; ``count(texts, table)`` adds the token numbers of some texts.

    Tasks hand on compressed parts of their tables; parts with the same number meet, so the driver gets one table.
    """
    width = -(-size // PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.zeros(width * PARTS, np.int64), False
        for batch in batches:
            seen = True
            held: list[np.ndarray] = []
            waiting = 0
            for value in batch.column(0):
                held.append(np.frombuffer(value.as_buffer(), kind).astype(np.int64))
                waiting += len(held[-1])
                if waiting > 500_000:
                    count(held, table)
                    held, waiting = [], 0
            count(held, table)
        if seen:
            pack = zstandard.ZstdCompressor(level=1).compress
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS)), pa.array([pack(t.tobytes()) for t in table.reshape(PARTS, width)], pa.binary())], names=["part", "table"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums.setdefault(part, np.zeros(width, np.int64))
                sums[part] += np.frombuffer(zstandard.decompress(blob), np.int64)
        pack = zstandard.ZstdCompressor(level=1).compress
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([pack(t.tobytes()) for t in sums.values()], pa.binary())], names=["part", "table"])

    schema = "part long, table binary"
    rows = numbers.mapInArrow(run, schema).repartition(PARTS, "part").mapInArrow(add, schema).collect()
    table = np.zeros((PARTS, width), np.int64)
    for r in rows:
        table[r["part"]] = np.frombuffer(zstandard.decompress(r["table"]), np.int64)
    return table.ravel()[:size]


def neighbours(numbers: DataFrame, head: Head, moving: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the first ``moving`` words how often each class follows it and precedes it, and the class bigrams."""
    c = head.n_classes
    by_number = head.class_table()
    cells = moving * c

    def count(texts: list[np.ndarray], table: np.ndarray) -> None:
        if not texts:
            return
        sizes = np.array([len(t) for t in texts])
        flat = np.concatenate(texts) if sizes.sum() else np.zeros(0, np.int64)
        last = np.cumsum(sizes)[sizes > 0] - 1
        follow, precede = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
        cls = by_number[flat]
        follow[:-1], precede[1:] = cls[1:], cls[:-1]
        follow[last] = END
        precede[last[:-1] + 1] = END
        if len(flat):
            precede[0] = END
        for at, other in ((0, follow), (cells, precede)):
            some = flat < moving
            table[at : at + cells] += np.bincount(flat[some] * c + other[some], minlength=cells)
        pairs = np.bincount(precede * c + cls, minlength=c * c) + np.bincount(cls[last] * c, minlength=c * c)
        pairs[END * c + END] += int((sizes == 0).sum())
        table[2 * cells : 2 * cells + c * c] += pairs

    table = _summed(numbers, 2 * cells + c * c, number_type(head), count)
    return table[: 2 * cells].reshape(2, moving, c), table[2 * cells :].reshape(c, c)


def _phi(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0)
    return x * np.log(np.maximum(x, 1))


def exchange(near: np.ndarray, pairs: np.ndarray, head: Head, movable: np.ndarray) -> np.ndarray:
    """The class of each of the first words that gives the likeliest class bigrams, one word moved at a time from the present classes."""
    moving, c = near.shape[1:]
    follow, precede = near.astype(float)
    total = pairs.sum(1).astype(float)
    classes = head.classes.copy()
    pairs = pairs.astype(float)
    own = np.arange(1 + SHAPES, c)
    for w in np.flatnonzero(movable[:moving]):
        a, n = classes[w], float(head.counts[w])
        out, into = pairs.copy(), total.copy()  # the counts without this word
        out[a] -= follow[w]
        out[:, a] -= precede[w]
        into[a] -= n
        np.maximum(out, 0, out=out)
        gain = (
            (_phi(out[own] + follow[w]) - _phi(out[own])).sum(1)
            + (_phi(out[:, own] + precede[w][:, None]) - _phi(out[:, own])).sum(0)
            - 2 * (_phi(into[own] + n) - _phi(into[own]))
        )
        b = own[int(np.argmax(gain))]
        if b != a and gain[b - own[0]] > gain[a - own[0]] + 1e-9 if a in own else True:
            pairs, total = out, into
            pairs[b] += follow[w]
            pairs[:, b] += precede[w]
            total[b] += n
            classes[w] = b
    return classes


def clustered(docs: DataFrame, head: Head, moving: int, rounds: int, text: str = "text") -> Head:
    """``exchanged`` for texts."""
    return exchanged(numbered(docs.select(text), head), head, moving, rounds)


def exchanged(numbers: DataFrame, head: Head, moving: int, rounds: int) -> Head:
    """Exchange clustering: the ``moving`` most frequent words start in classes of their own or, from the ``classes``-th on,
    by rank; every round counts their neighbours' classes over all texts and moves them.  In later rounds every other word may move,
    so that neighbours don't swap places; it takes three rounds for each to move twice."""
    moving = min(moving, len(head.words))
    for turn in range(rounds):
        if not moving:
            break
        near, pairs = neighbours(numbers, head, moving)
        movable = np.ones(moving, bool) if turn == 0 else np.arange(moving) % 2 == turn % 2
        head.classes = exchange(near, pairs, head, movable)
    return head


@dataclass
class Model:
    """Witten-Bell smoothed class trigrams and word emissions."""

    head: Head
    trigram: np.ndarray  # log10 of P(c3 | c1, c2)
    emission: np.ndarray  # log10 of P(word | class) of head words; 0 for shapes, whose words' are added apart
    total: int
    distinct: int
    tail_tokens: np.ndarray
    tail_words: np.ndarray


def transitions(numbers: DataFrame, head: Head) -> np.ndarray:
    """Class trigrams over all texts, two starts before each and one end after it."""
    c = head.n_classes
    by_number = head.class_table()

    def count(texts: list[np.ndarray], table: np.ndarray) -> None:
        for row in _padded(texts, by_number):
            table += np.bincount((row[:-2] * c + row[1:-1]) * c + row[2:], minlength=len(table)) - _between(texts, row, c, len(table))

    return _summed(numbers, c**3, number_type(head), count).reshape(c, c, c)


def _padded(texts: list[np.ndarray], by_number: np.ndarray) -> Iterator[np.ndarray]:
    """Classes of some texts in a row: END END text END END text END ..."""
    if texts:
        gap = np.full(2, END)
        parts = [gap]
        for t in texts:
            parts += [by_number[t], gap]
        yield np.concatenate(parts)


def _between(texts: list[np.ndarray], numbers: np.ndarray, c: int, size: int) -> np.ndarray:
    """Trigrams that end in the second END after a text: they belong to no text."""
    ends = 2 + np.cumsum([len(t) + 2 for t in texts]) - 1
    return np.bincount((numbers[ends - 2] * c + numbers[ends - 1]) * c + numbers[ends], minlength=size)


def smoothed(trigrams: np.ndarray) -> np.ndarray:
    """Witten-Bell: each order backs off to the next with the share of its distinct continuations."""
    c = len(trigrams)
    unigram = (trigrams.sum((0, 1)) + 0.1) / (trigrams.sum() + 0.1 * c)

    def order(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        kinds = np.maximum((counts > 0).sum(-1, keepdims=True), 1)
        return (counts + kinds * lower) / (counts.sum(-1, keepdims=True) + kinds)

    return order(trigrams, order(trigrams.sum(0), unigram)[None])


ALPHA = 0.1


def scores(
    docs: DataFrame, key: str = "doc_id", text: str = "text", head_words: int = 32_768, moving: int | None = None, classes: int = 48, rounds: int = 3
) -> DataFrame:
    """Score every text with a class model learned from those not held out.  All words of the head are exchanged, or the ``moving`` first.

    Returns the key, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities).  A null or empty text is its end token.
    Rows that repeat a key, or have none, are scored each; other columns are not read.  Without training texts all probabilities are smoothed from nothing.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), held_out(key).alias("held_out"))
    train = rows.where(~F.col("held_out")).select("text")
    counts = stored(word_counts(train))
    figures = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    ends = train.count()
    total, distinct = (figures["n"] or 0) + ends, figures["v"] + (ends > 0)

    top = counts.orderBy(F.desc("n"), "word").limit(head_words).collect()
    n_classes = 1 + SHAPES + classes
    head = Head([bytes(r["word"]) for r in top], np.array([r["n"] for r in top], np.int64), np.zeros(0, np.int64), n_classes)
    rank = np.arange(len(top))
    head.classes = 1 + SHAPES + np.where(rank < classes, rank, rank % classes)
    numbers = numbered(train, head)
    head = exchanged(numbers, head, len(head.words) if moving is None else moving, rounds)

    tail = counts.where(~_in_head(head)) if top else counts
    by_shape = {r["shape"]: r for r in tail.groupBy(shape_column("word").alias("shape")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    tail_tokens = np.array([by_shape[s]["n"] if s in by_shape else 0 for s in range(SHAPES + 1)], float)
    tail_words = np.array([by_shape[s]["v"] if s in by_shape else 0 for s in range(SHAPES + 1)], float)
    in_class = np.bincount(head.classes, weights=head.counts, minlength=n_classes)
    emission = np.concatenate([np.log10(head.counts / in_class[head.classes]) if len(top) else np.zeros(0), np.zeros(SHAPES + 1)])
    model = Model(head, np.log10(smoothed(transitions(numbers, head))), emission, total, distinct, tail_tokens, tail_words)
    return _scored(rows, counts, model, ends).withColumnRenamed("key", key)


def _in_head(head: Head) -> Column:
    """Whether a counted word is one of the head: more frequent than its last word, or as frequent and not after it."""
    last, n = head.words[-1], int(head.counts[-1])
    return (F.col("n") > n) | ((F.col("n") == n) & (F.col("word") <= F.lit(last)))


def _scored(rows: DataFrame, counts: DataFrame, model: Model, ends: int) -> DataFrame:
    """Each row's own part, plus the parts of its words outside the head, which meet their counts by a join."""
    head = model.head
    base = len(head.words)
    scale = model.total + ALPHA * (model.distinct + 1)
    log_base = np.concatenate([np.log10((head.counts + ALPHA) / scale), np.zeros(SHAPES + 1)])
    log_end = float(np.log10((ends + ALPHA) / scale))
    by_number, c = head.class_table(), head.n_classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = head.index()
        flat = model.trigram.ravel()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(3)
            row, word, times, own = [], [], [], []
            for i, value in zip(ids, texts, strict=True):
                found = tokens(value.as_py())
                numbers = head.ids(index, found)
                classes = np.concatenate([[END, END], by_number[numbers], [END]])
                score = flat[(classes[:-2] * c + classes[1:-1]) * c + classes[2:]].sum() + model.emission[numbers].sum()
                rare = np.flatnonzero(numbers >= base)
                own.append((len(found) + 1, len(found) - len(rare) + (ends > 0), log_base[numbers].sum() + log_end, score))
                seen = Counter([found[j] for j in rare.tolist()])
                row += [i] * len(seen)
                word += seen.keys()
                times += seen.values()
                if len(row) > 100_000:
                    yield _parts(row, word, times, pa.nulls(len(row), own_type))
                    row, word, times = [], [], []
            yield _parts(row, word, times, pa.nulls(len(row), own_type))
            # a row's own figures go under a mark that is no word, as it has a space: it meets no count and spreads evenly
            figures = [pa.array([o[j] for o in own], t.type) for j, t in enumerate(list(own_type)[2:])]
            own_part = pa.StructArray.from_arrays([batch.column(1).cast(own_type[0].type), batch.column(2), *figures], fields=list(own_type))
            yield _parts(ids, [b" %d" % i for i in ids], [0] * len(ids), own_part)

    # the number is drawn once and a row's key goes with its own figures: another evaluation could number the rows otherwise
    keyed = rows.select(F.monotonically_increasing_id().alias("row"), "key", "held_out", "text")
    kind = rows.schema["key"].dataType
    own_type = pa.struct(
        [("key", to_arrow_type(kind)), ("held_out", pa.bool_()), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]
    )
    own_of = f"struct<key: {kind.simpleString()}, held_out: boolean, tokens: long, known: long, base: double, score: double>"
    tails = keyed.mapInArrow(run, f"row long, word binary, times long, own {own_of}")
    shape_of = shape_column("word")
    tokens_of = F.element_at(F.array(*[F.lit(float(x)) for x in model.tail_tokens]), shape_of + 1)
    words_of = F.element_at(F.array(*[F.lit(float(x)) for x in model.tail_words]), shape_of + 1)
    seen = F.coalesce("n", F.lit(0))
    parts = (
        tails.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.max("own.key").alias("key"),
            F.max("own.held_out").alias("held_out"),
            F.max("own.tokens").alias("n_tokens"),
            (F.max("own.known") + F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0))).alias("n_known"),
            (F.max("own.base") + F.sum(F.col("times") * F.log10((seen + ALPHA) / F.lit(float(scale))))).alias("base_score"),
            (F.max("own.score") + F.sum(F.col("times") * F.log10((seen + ALPHA) / (tokens_of + ALPHA * (words_of + 1))))).alias("score"),
        )
    )
    return parts.select("key", "held_out", "n_tokens", "n_known", F.lit(int(model.total)).cast("long").alias("train_tokens"), "base_score", "score")


def _parts(row: list[int], word: list[bytes], times: list[int], own: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(word, pa.binary()), pa.array(times, pa.int64()), own], names=["row", "word", "times", "own"])
