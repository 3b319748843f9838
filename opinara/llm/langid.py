"""Language identification in two steps: the family first, then one support vector machine for each two languages of it.

Features are byte n-grams of the lower-cased text, hashed to a fixed number of places.  A multinomial linear model names the family.
Within a family each two languages have a linear support vector machine of their own, whose weights need tell only those two apart, and
the language with most votes wins; margins decide between equals.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from opinara.llm.arrays import LOWER, chunks, mix, powers
from opinara.llm.durable import stored

# Families of languages by their ISO 639-1 code; others are a family of their own each.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv kw",
    "uralic": "et fi hu se",
    "turkic": "az kk ky tk tr tt ug uz",
    "indic": "as bn gu hi mr ne or pa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "sinitic": "yue zh",
    "dravidian": "kn ml ta te",
    "malayic": "id jv ms su",
}
UNKNOWN = "und"

PLACES, GRAMS = 1024, (1, 2, 3)
#: Bytes of text hashed, and rows counted, in one go.
SLICE, ROWS = 1 << 19, 256

#: Spaces, digits, punctuation and control bytes of ASCII all count as one space.
_BYTES = LOWER.copy()
_BYTES[[b for b in range(128) if not chr(b).isalpha()]] = 32
TOP = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15


def family_of(lang: str, families: Mapping[str, str] = FAMILIES) -> str:
    return next((name for name, codes in families.items() if lang in codes.split()), lang)


def _counts(data: np.ndarray, row: np.ndarray, rows: int, places: int) -> np.ndarray:
    """Hashed n-grams of each row; a gram that crosses rows isn't one."""
    out = np.zeros(rows * places, np.float64)
    value = data.astype(np.uint64) + np.uint64(1)
    for size in GRAMS:
        n = len(value) - size + 1
        if n <= 0:
            break
        total = np.zeros(n, np.uint64)
        for j, power in enumerate(powers(_BASE, size)):
            total += value[j : j + n] * power
        at = np.flatnonzero(row[:n] == row[size - 1 :])
        place = (mix(total[at]) % np.uint64(places)).astype(np.int64)
        out += np.bincount(row[at] * places + place, minlength=rows * places)
    return out.reshape(rows, places)


def gram_features(column: pa.Array, places: int = PLACES) -> Iterator[np.ndarray]:
    """Rows' features, some rows at a time: roots of the n-gram counts of the whole text, scaled to length 1.  A text without bytes has zeros."""
    for chunk in chunks(column, SLICE):
        for first in range(0, len(chunk), ROWS):
            bounds = chunk.bounds[first : first + ROWS + 1]
            counts = np.zeros((len(bounds) - 1, places))
            for start in range(int(bounds[0]), int(bounds[-1]), SLICE):  # more than one slice only of a long text
                end = min(int(bounds[-1]), start + SLICE)
                lead = start if start == bounds[0] else start - max(GRAMS) + 1
                data = _BYTES[chunk.data[lead:end]]
                row = np.searchsorted(bounds, np.arange(lead, end), "right") - 1
                counts += _counts(data, row, len(counts), places)
                if lead < start:  # the overlap's own grams were counted before
                    counts -= _counts(data[: start - lead], row[: start - lead], len(counts), places)
            root = np.sqrt(np.maximum(counts, 0))
            yield root / np.maximum(np.linalg.norm(root, axis=1, keepdims=True), 1e-12)


@dataclass
class Languages:
    """Weights and intercepts: a row for each family, and for each two languages of one."""

    langs: list[str]
    family: list[int]
    family_weights: np.ndarray
    family_bias: np.ndarray
    pairs: list[tuple[int, int]]
    pair_weights: np.ndarray
    pair_bias: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each row's language, and a score: the family's chance times the mean chance against its nearest languages."""
        logit = x @ self.family_weights.T + self.family_bias
        chance = np.exp(logit - logit.max(1, keepdims=True))
        chance /= chance.sum(1, keepdims=True)
        chosen = chance.argmax(1)
        votes, won = np.zeros((len(x), len(self.langs))), np.zeros((len(x), len(self.langs)))
        rivals = np.zeros(len(self.langs))
        margins = x @ self.pair_weights.T + self.pair_bias if self.pairs else np.zeros((len(x), 0))
        for (a, b), margin in zip(self.pairs, margins.T, strict=True):
            p = 1 / (1 + np.exp(-np.clip(2 * margin, -30, 30)))
            for lang, mine in ((a, 1 - p), (b, p)):
                votes[:, lang] += mine > 0.5
                won[:, lang] += mine
                rivals[lang] += 1
        member = np.array(self.family)[None, :] == chosen[:, None]
        rank = np.where(member, votes + won / (1 + rivals), -1.0)
        lang = rank.argmax(1)
        mean = np.where(rivals[lang] > 0, won[np.arange(len(x)), lang] / np.maximum(rivals[lang], 1), 1.0)
        return lang, chance[np.arange(len(x)), chosen] * mean


def held_out(key: str, folds: int = 4, fold: int = 2) -> Column:
    """True for keys whose crc32, as text, leaves ``fold``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == fold


def _at_most(rows: DataFrame, bounds: dict[str, int]) -> DataFrame:
    """The rows whose ``h`` is at most their language's bound."""
    return rows.where(F.col("h") <= F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])[F.col("lang")])


def training_rows(docs: DataFrame, key: str, text: str, lang: str, per_language: int) -> DataFrame:
    """``lang`` and ``vector`` of distinct texts with a letter, outside the held-out fold: of each language the ``per_language`` whose hashes are lowest.

    Only hashes are ranked.  The texts stay where they are and each task compares theirs with their language's bound.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}") & ~held_out(key)).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.shiftrightunsigned(F.xxhash64(F.lit(13), text), 1).alias("h")
    )
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}  # as many rows as languages
    if not sizes:
        return docs.sparkSession.createDataFrame([], "lang string, h long, vector array<double>")
    # of a large language only so many low hashes are ranked as hold the wanted ones by far
    ranked = _at_most(known.select("lang", "h"), {x: min(TOP, 4 * per_language * TOP // n) for x, n in sizes.items()}).distinct()
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h"))
    last = {r.lang: r.h for r in ranked.withColumn("rank", rank).where(F.col("rank") <= per_language).groupBy("lang").agg(F.max("h").alias("h")).collect()}
    chosen = _at_most(known, last).groupBy("lang", "h").agg(F.first("text").alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in gram_features(batch.column("text")):
                flat = pa.array(x.ravel(), pa.float64())
                offsets = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
                yield pa.RecordBatch.from_pydict({"lang": batch.column("lang").slice(at, len(x)), "h": batch.column("h").slice(at, len(x)), "vector": pa.ListArray.from_arrays(offsets, flat)})
                at += len(x)

    return chosen.select("lang", "h", "text").mapInArrow(vectors, "lang string, h long, vector array<double>")


def fit(rows: DataFrame, families: Mapping[str, str] = FAMILIES, penalty: float = 1e-4, rounds: int = 40) -> Languages | None:
    """The models from ``lang`` and ``vector``, by ``pyspark.ml`` on the rows as Spark has dealt them; None without any row."""
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())
    if not langs:
        return None
    named = sorted({family_of(x, families) for x in langs})
    family = [named.index(family_of(x, families)) for x in langs]
    number = F.create_map(*[F.lit(x) for i, x in enumerate(langs) for x in (x, i)])
    parent = F.create_map(*[F.lit(x) for i, x in zip(family, langs, strict=True) for x in (x, i)])
    data = stored(rows.select(number[F.col("lang")].alias("lang"), parent[F.col("lang")].cast("double").alias("family"), array_to_vector("vector").alias("features")))
    # each language weighs the same, however many texts it has
    weighed = data.join(data.groupBy("lang").agg((1 / F.count("*")).alias("weight")), "lang")

    weights, bias = np.zeros((1, PLACES)), np.zeros(1)
    if len(named) > 1:
        model = LogisticRegression(featuresCol="features", labelCol="family", weightCol="weight", family="multinomial", regParam=penalty, maxIter=rounds, standardization=False).fit(weighed)
        weights, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()

    pairs, pair_weights, pair_bias = [], [], []
    for a, b in combinations(range(len(langs)), 2):
        if family[a] == family[b]:
            two = weighed.where(F.col("lang").isin(a, b)).withColumn("second", (F.col("lang") == b).cast("double"))
            machine = LinearSVC(featuresCol="features", labelCol="second", weightCol="weight", regParam=penalty, maxIter=rounds, standardization=False).fit(two)
            pairs.append((a, b))
            pair_weights.append(machine.coefficients.toArray())
            pair_bias.append(machine.intercept)
    return Languages(langs, family, weights, bias, pairs, np.array(pair_weights).reshape(len(pairs), PLACES), np.array(pair_bias))


def languages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 1000, families: Mapping[str, str] = FAMILIES
) -> DataFrame:
    """Every document with ``held_out``, ``lang_pred`` and ``score`` (0 to 1).

    The models learn from at most ``per_language`` distinct texts of each language, those whose hashes are lowest, outside the held-out fold; all
    whole texts are predicted.  A text that is null or without a letter is ``und`` with score 0, as are all where nothing could be learned.
    Rows without a language teach nothing, repeated rows teach once and are predicted each, a null key counts as the
    empty text, other columns play no part.
    """
    model = fit(training_rows(docs, key, text, lang, per_language), families)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, at = batch.column("letters").to_numpy(zero_copy_only=False), 0
            for x in gram_features(batch.column("text")) if model is not None else [np.zeros((len(letters), 0))]:
                seen = letters[at : at + len(x)]
                named, score = np.full(len(x), UNKNOWN, object), np.zeros(len(x))
                if model is not None:
                    found, chance = model.predict(x)
                    named[seen], score[seen] = np.array(model.langs, object)[found[seen]], np.minimum(chance[seen], 1.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(at, len(x)), batch.column("held_out").slice(at, len(x)), pa.array(named, pa.string()), pa.array(score)], [key, "held_out", "lang_pred", "score"]
                )
                at += len(x)

    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    seen = docs.select(F.col(key).alias("key"), held_out(key).alias("held_out"), lettered.alias("letters"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return seen.mapInArrow(predict, f"`{key}` {kind}, held_out boolean, lang_pred string, score double")
