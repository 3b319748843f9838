"""Spelling variants grouped by asymmetric q-chunks.

Of two words one edit apart, the shorter one (either, where both are as long) is cut into two disjoint chunks; the edit
leaves one of them whole, in its place or shifted by one.  The longer one shows the grams that could be such a chunk: a
gram's length and place follow from the length of the shorter word, so what would meet no chunk within a shift of one isn't made.
Words that share a chunk are compared.

A chunk that many words share says too little: its words cut what the chunk leaves open in two again, and so on until
the groups are small or nothing but the edit is open.  No group is left out and none is paired as a whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.durable import stored

# The letters of a run, and the letters that are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

#: Characters of a text looked at in one go, and words counted before the counts travel.
SLICE, FLUSH = 1 << 20, 1 << 17
#: Words that share a chunk and are compared with each other; larger groups are refined.
GROUP = 128


def _slices(text: str, size: int = SLICE) -> Iterator[str]:
    """The text in parts that cut no run of letters."""
    edge = re.compile(f"[^{LETTERS}]")
    at = 0
    while len(text) - at > size:
        cut = edge.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:] if at else text


def misspelt(run: str, seed: int, every: int) -> str:
    """The run, or the run less one code point where its hash, started from ``seed``, is divided by ``every``."""
    h = zlib.crc32(run.encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 6, every: int = 199) -> DataFrame:
    """``word`` and ``n``, occurrences over all texts, of words of ``least_length`` code points or more.

    Words are maximal runs of letters, A-Z lower-cased; where ``every`` divides the crc32 of "key:word", one code point is taken out.
    """
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"word": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})
            found.clear()
            return batch

        for batch in batches:
            for name, whole in zip(batch.column(0), batch.column(1), strict=True):
                seed = zlib.crc32(f"{name.as_py() if name.is_valid else ''}:".encode())
                for part in _slices(whole.as_py() or ""):
                    for run, n in Counter(runs.findall(part)).items():
                        word = misspelt(run.lower() if run.isascii() else run.translate(_LOWER), seed, every)
                        if len(word) >= least_length:
                            found[word] += n
                if len(found) >= FLUSH:
                    yield flushed()
        if found:
            yield flushed()

    named = docs.where(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return named.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _halved(rows: DataFrame) -> DataFrame:
    """Each row twice, its chunk being all of the word but what is open: of that the first half is taken in, or else the second.

    Of a single open letter beside an inserted one either the one or the other side is taken in.
    """
    is_open = F.col("len") - F.col("a") - F.col("b")
    least = F.col("longer").cast("int")
    half = F.greatest(F.floor(is_open / 2), least).cast("int")
    rest = F.greatest(is_open - half, least)
    ends = F.array(F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b")), F.struct(F.col("a").alias("a"), (F.col("b") + rest).alias("b")))
    return rows.select("word", "n", "len", "longer", "grams", F.inline(ends)).withColumn(
        "chunk", F.xxhash64("len", "longer", "a", "b", F.substring("word", F.lit(1), F.col("a")), F.expr("right(word, b)"))
    )


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """All pairs of distinct words that differ by one inserted, deleted or replaced code point, each once: ``left``, ``left_n``, ``right``, ``right_n``.

    ``words`` has a row for each ``word``, with its ``n``.  Pairs of equally long words and of words of which one is ``longer`` are looked for apart.
    """
    size = F.char_length("word")
    whole = words.where(size > 0).select("word", "n", F.lit(0).alias("a"), F.lit(0).alias("b"), size.alias("own"))
    kinds = ((F.col("own"), False, False), (F.col("own"), True, False), (F.col("own") - 1, True, True))
    parts = [whole.where(length > 0).withColumns({"len": length, "longer": F.lit(longer), "grams": F.lit(grams)}).drop("own") for length, longer, grams in kinds]
    rows, found = reduce(DataFrame.unionByName, parts), []
    # equally long words are at last open in one code point, and all make pairs then; of the others only the inserted one is open
    closed = F.when(F.col("longer"), 0).otherwise(1)
    n_all, paired = F.col("n_chunks") + F.col("n_grams"), (F.col("n_chunks") > 0) & F.when(F.col("longer"), F.col("n_grams") > 0).otherwise(F.col("n_chunks") > 1)
    while not found or not rows.isEmpty():
        rows = _halved(rows)
        sizes = rows.groupBy("chunk").agg(F.count_if("grams").alias("n_grams"), F.count_if(~F.col("grams")).alias("n_chunks"))
        large = (n_all > group) & (F.col("len") - F.col("a") - F.col("b") > closed)
        kept = stored(rows.join(sizes, "chunk").where(paired).withColumn("large", large).drop("n_grams", "n_chunks"))
        found.append(_compared(kept.where("not large")))
        rows = kept.where("large").drop("large", "chunk")
    return reduce(DataFrame.unionByName, found).distinct()  # repeated letters make a pair meet in both halves


def _compared(rows: DataFrame) -> DataFrame:
    """Pairs within the groups of the chunks that are one edit apart."""
    side = rows.where("not grams").select("chunk", F.col("word").alias("left"), F.col("n").alias("left_n"))
    other = rows.where("grams or not longer").select("chunk", "grams", F.col("word").alias("right"), F.col("n").alias("right_n"))
    pairs = side.join(other, "chunk").where((F.col("grams") | (F.col("left") < F.col("right"))) & (F.levenshtein("left", "right", 1) == 1))
    return pairs.select("left", "left_n", "right", "right_n")


def _roots(links: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of links (word, form); each round doubles the steps made.

    A form has more occurrences than its word, so chains end.
    """
    at = stored(links.select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = stored(at.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.drop("moved")


def spelling_variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 6, least_n: int = 5, factor: int = 5, every: int = 199, group: int = GROUP
) -> DataFrame:
    """One row a word with at least ``least_n`` occurrences: ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    ``n_near`` counts the words one edit away.  The commonest of them (of equals the first in code-point order) is the word's form if it
    occurs ``factor`` times as often or more; ``root`` is where the forms end, the word itself where it has none.  Null texts have no
    words, a null key is the empty text, each of repeated rows counts, other columns play no part, and an empty table gives no row.
    """
    words = stored(word_counts(docs, key, text, least_length, every).where(F.col("n") >= least_n))
    pairs = near_pairs(words, group)
    ends = [F.struct(F.col(x).alias("word"), F.struct((-F.col(f"{y}_n")).alias("less"), F.col(y).alias("form")).alias("best")) for x, y in (("left", "right"), ("right", "left"))]
    near = pairs.select(F.inline(F.array(*ends))).groupBy("word").agg(F.count("*").alias("n_near"), F.min("best").alias("best"))
    common = -F.col("best.less") >= factor * F.col("n")
    formed = stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
