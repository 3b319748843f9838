"""Quality rules that vote: weak supervision instead of "every rule must pass".

Each rule votes keep (+1), reject (-1) or abstains (0) on a document.  Documents with the
same votes are one pattern; there are at most 3**rules patterns, whatever the corpus size,
so expectation-maximisation over pattern counts estimates each rule's accuracy from all
documents, and a document's verdict is its pattern's posterior probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.arrays import SPACE, Chunk, chunks, ngrams, span_hashes, words
from opinara.llm.durable import stored

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_chars long, n_upper long, n_stops long, n_letters long"
_STARTS = np.ones(256, bool)
_STARTS[0x80:0xC0] = False
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True


def _per_row(mask: np.ndarray, chunk: Chunk) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[chunk.bounds[1:]] - sums[chunk.bounds[:-1]]


def _duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line.split():
            found += line in seen
            seen.add(line)
    return found


def _repeated_words(row: np.ndarray, hashes: np.ndarray, rows: int, window: int) -> np.ndarray:
    """Words inside windows that occur twice or more in their row."""
    grams, at = ngrams(hashes, row, window)
    if not len(at):
        return np.zeros(rows, np.int64)
    _, group, count = np.unique(grams ^ (row[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), return_inverse=True, return_counts=True)
    hit = at[count[group] > 1]
    steps = np.zeros(len(row) + 1, np.int64)
    np.add.at(steps, hit, 1)
    np.add.at(steps, hit + window, -1)
    return np.bincount(row[np.cumsum(steps[:-1]) > 0], minlength=rows)


def measure(chunk: Chunk, window: int = WINDOW) -> dict[str, np.ndarray]:
    """The figures of ``FEATURES`` for every row of a chunk."""
    found, rows, data = words(chunk), len(chunk), chunk.data
    lead = _STARTS[data]
    first = found.first_of(rows)
    return {
        "n_words": np.diff(first),
        "word_chars": _per_row(lead & ~SPACE[data], chunk),
        "n_symbols": _per_row(_SYMBOL[data], chunk),
        "n_dup_lines": np.array([_duplicate_lines(chunk.raw(i)) for i in range(rows)], np.int64),
        "n_repeat_words": _repeated_words(found.row, span_hashes(data, found.start, found.end), rows, window),
        "n_lines": _per_row(data == 10, chunk) + 1,
        "n_chars": _per_row(lead, chunk),
        "n_upper": _per_row(_UPPER[data], chunk),
        "n_stops": _per_row(_STOP[data], chunk),
        "n_letters": _per_row(_LETTER[data] & lead, chunk),
    }


def text_measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key and the figures of ``FEATURES``; a null text is empty."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                yield pa.RecordBatch.from_pydict({key: batch.column(0).slice(chunk.first, len(chunk)), **measure(chunk)})

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {FEATURES}")


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns with the figures of ``FEATURES`` beside them; a null text is empty.  No column may have the name of a figure."""
    at = docs.columns.index(text)
    schema = docs.limit(0).withColumns({f.split()[0]: F.lit(0).cast("long") for f in FEATURES.split(", ")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(at)):
                some = batch.slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays([*some.columns, *(pa.array(v, pa.int64()) for v in measure(chunk).values())], names=schema.names)

    return docs.mapInArrow(run, schema)


def share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def votes() -> dict[str, Column]:
    """The voting rules: +1 keep, -1 reject, 0 abstain.

    A rule speaks where its figure says something.  Few texts repeat their lines or shout, so that one doesn't is no reason to keep it: such rules
    reject or abstain.  Rules on the make-up of a text vote both ways, with a band between in which they abstain.
    """

    def rule(reject: Column, keep: Column | None = None) -> Column:
        vote = F.when(reject, -1)
        return (vote if keep is None else vote.when(keep, 1)).otherwise(0)

    mean, symbols, letters = share("word_chars", "n_words"), share("n_symbols", "n_words"), share("n_letters", "n_chars")
    marks = (F.col("word_chars") - F.col("n_letters")) / F.greatest("word_chars", F.lit(1))
    return {
        "length": rule(F.col("n_words") < 20),
        "word_length": rule((mean < 2.5) | (mean > 14)),
        "symbols": rule(symbols > 0.1, symbols < 0.02),
        "marks": rule(marks > 0.15, marks < 0.06),
        "letters": rule(letters < 0.74, letters > 0.77),
        "lines": rule(share("n_dup_lines", "n_lines") > 0.3),
        "repeats": rule(share("n_repeat_words", "n_words") > 0.3),
        "capitals": rule(share("n_upper", "n_chars") > 0.4),
        "sentences": rule((F.col("n_words") >= 50) & (F.col("n_stops") == 0)),
    }


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Rule accuracies and each pattern's posterior of good quality, by expectation-maximisation.

    ``patterns``: votes (-1, 0, 1), a row per pattern.  It starts from the majority of the votes, halves where they are even.  Accuracies stay within
    0.55 and 0.99: a rule is taken to be better than chance, which fixes which of the two classes is the good one.
    """
    new = (1 + np.sign(patterns.sum(1))) / 2
    accuracy, prior, total = np.full(patterns.shape[1], 0.8), 0.5, max(counts.sum(), 1)
    for _ in range(rounds):
        posterior = new
        agree = (counts[:, None] * np.where(patterns > 0, posterior[:, None], np.where(patterns < 0, 1 - posterior[:, None], 0))).sum(0)
        voted = (counts[:, None] * (patterns != 0)).sum(0)
        accuracy = np.clip((agree + 4) / (voted + 5), 0.55, 0.99)
        prior = float(np.clip((counts * posterior).sum() / total, 0.05, 0.95))
        right, wrong = np.log(accuracy), np.log(1 - accuracy)
        good = np.where(patterns > 0, right, 0).sum(1) + np.where(patterns < 0, wrong, 0).sum(1) + np.log(prior)
        bad = np.where(patterns > 0, wrong, 0).sum(1) + np.where(patterns < 0, right, 0).sum(1) + np.log(1 - prior)
        new = 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))
        if np.abs(new - posterior).max(initial=0) < 1e-9:
            break
    return accuracy, new, prior


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """Each document with its figures, the base verdict, ``kept`` and the posterior.

    A document is kept if it passes the base rule and its posterior is ``least`` or more.  A null text is empty; an empty text has zero figures and
    fails the base rule.  Rows that repeat a key, and rows with a null key, are judged each on its own.  Other columns are not read.
    """
    rules = votes()
    code = sum(((v + 1) * 3**i for i, v in enumerate(rules.values())), F.lit(0)).cast("int")
    measured = stored(text_measures(docs, key, text).withColumn("code", code))
    rows = measured.groupBy("code").count().collect()  # at most 3**rules patterns
    codes = np.array(sorted(r["code"] for r in rows), np.int64)
    count = {r["code"]: r["count"] for r in rows}
    patterns = (codes[:, None] // 3 ** np.arange(len(rules))) % 3 - 1
    _, posterior, _ = estimate(patterns, np.array([count[c] for c in codes], float))
    judged = docs.sparkSession.createDataFrame([(int(c), float(p)) for c, p in zip(codes, posterior, strict=True)], "code int, posterior double")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.join(F.broadcast(judged), "code").select(
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= least)).alias("kept"), "posterior",
    )
