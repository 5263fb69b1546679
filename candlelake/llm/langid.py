"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies count every labelled training row. The weights are fitted by
follow-the-regularised-leader with an elastic net (an L1 part that keeps them sparse, an L2 part that
keeps them small) on a sample of at most ``MOST_TRAINING`` rows, evenly over the languages, in
one task. One part in five of the sample is kept out of the fit and sets the temperature that
turns scores into calibrated probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.llm.stages import map_arrow

UNKNOWN = "und"
# sample bound, hashed features, and the settings of the fit
MOST_TRAINING = 6000
BITS = 14
ALPHA, BETA, L1, L2, EPOCHS = 0.3, 1.0, 0.002, 0.0002, 3
_LETTER = regex.compile(r"\p{L}")
_CHUNK = 1 << 20
_SHARES = 1 << 20
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def counts_of(text: str) -> np.ndarray:
    """Counts of the hashed 1-, 2- and 3-grams of the lower-cased characters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    total = np.zeros(1 << BITS, np.int64)
    for low in range(0, len(codes), _CHUNK):
        part = codes[low : low + _CHUNK + 2].astype(np.uint64)
        own = min(_CHUNK, len(codes) - low)
        sums = np.zeros(len(part), np.uint64)
        for n in range(3):
            sums = sums[: len(part) - n] + part[n:] * _FACTORS[n]
            mixed = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * n)
            total += np.bincount((mixed[:own] >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    return total


def vector_of(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and their TF-IDF values, with unit length."""
    counts = counts_of(text)
    features = np.flatnonzero(counts)
    values = np.log1p(counts[features]) * idf[features]
    return features, values / max(np.sqrt(values @ values), 1e-12)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        features, values = vector_of(text, self.idf)
        p = softmax((values @ self.weights[features] + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(min(p[best], 1.0))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal passes over ``(features, values, class)`` rows; the last feature is the bias, without L1."""
    size = (1 << BITS) + 1
    z, n = np.zeros((size, classes)), np.zeros((size, classes))
    l1 = np.full((size, 1), L1)
    l1[-1] = 0

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for features, values, label in rows:
            at = np.append(features, size - 1)
            x = np.append(values, 1.0)
            w = weights(at)
            slope = softmax(x @ w)
            slope[label] -= 1
            g = x[:, None] * slope
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(size))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log-loss, from a grid that is refined once."""
    if not len(labels):
        return 1.0

    def loss(t):
        return -np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean()

    best = min(np.geomspace(0.02, 5, 40), key=loss)
    return float(min(np.geomspace(best / 1.15, best * 1.15, 21), key=loss))


def held_out():
    """Rows that are never learned from: CRC-32 of the id as text leaves 2 modulo 4. Null ids are held out too."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def train(docs: DataFrame) -> Model:
    """Fit a model on rows of ``docs`` that aren't held out and have a text and a language."""
    known = docs.select("doc_id", "text", "lang").where(~held_out()).where("text is not null and lang is not null")
    rows_of = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy("lang").collect()}
    languages = list(rows_of)
    if not languages:
        return Model([], np.zeros(0), np.zeros((0, 0)), np.zeros(0), 1.0)

    def frequencies(batches):
        total, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                total += counts_of(text.as_py()) > 0
                n += 1
        features = np.append(np.flatnonzero(total), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(features), pa.array(np.append(total[total > 0], n))], names=["feature", "n"]
        )

    sums = known.select("text").mapInArrow(frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = {r["feature"]: r["n"] for r in sums.collect()}
    n = found.pop(-1)
    idf = np.full(1 << BITS, np.log(1 + n) + 1)
    idf[list(found)] -= np.log(1 + np.array(list(found.values())))

    each = max(1, MOST_TRAINING // len(languages))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    # a language's share by hash, a little more than asked for, so that few rows meet to be ranked
    share = F.lit(0)
    for language, rows in rows_of.items():
        share = F.when(F.col("lang") == language, int(_SHARES * min(1.0, 1.3 * each / rows)) + 1).otherwise(share)
    # rows that repeat id, text and language count once, so the sample is bounded however often an id repeats
    row = ["doc_id", "lang", "th"]
    hashed = known.withColumn("th", F.xxhash64("text"))
    drawn = hashed.where(F.pmod(F.xxhash64(F.lit("draw"), "doc_id"), F.lit(_SHARES)) < share).select(row).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(order, "doc_id", "th"))
    chosen = drawn.withColumn("rank", rank).where(F.col("rank") <= each).select(row)
    # at most MOST_TRAINING rows
    sample = hashed.join(F.broadcast(chosen), row).dropDuplicates(row).withColumn("order", order)
    index = {language: i for i, language in enumerate(languages)}

    def vectors(batch):
        pairs = [vector_of(text.as_py(), idf) for text in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([index[x] for x in batch["lang"].to_pylist()], pa.int32()),
                batch["order"],
                pa.array([f.astype("<u2").tobytes() for f, _ in pairs], pa.binary()),
                pa.array([v.astype("<f4").tobytes() for _, v in pairs], pa.binary()),
            ],
            names=["label", "order", "features", "vals"],
        )

    def fit(batches):
        rows = []
        for batch in batches:
            for label, order, f, v in zip(*(batch[c].to_pylist() for c in ("label", "order", "features", "vals"))):
                rows.append((order, np.frombuffer(f, "<u2").astype(np.int64), np.frombuffer(v, "<f4"), label))
        if not rows:
            return
        rows.sort(key=lambda r: r[0])
        # one in five sets the temperature; tiny samples are used for both
        kept_out = rows[::5] if len(rows) >= 50 else rows
        fitted = [r for i, r in enumerate(rows) if i % 5] if len(rows) >= 50 else rows
        w, bias = fit_weights([r[1:] for r in fitted], len(languages))
        logits = np.array([v @ w[f] + bias for _, f, v, _ in kept_out])
        t = fit_temperature(logits, np.array([r[3] for r in kept_out]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.tobytes()], pa.binary()), pa.array([bias.tobytes()], pa.binary()), pa.array([t])],
            names=["weights", "bias", "temperature"],
        )

    rows = map_arrow(sample.select("text", "lang", "order"), vectors, "label int, order long, features binary, vals binary")
    # the sample is bounded, so one task can hold it
    fitted = rows.repartition(1).mapInArrow(fit, "weights binary, bias binary, temperature double").collect()[0]
    weights = np.frombuffer(fitted["weights"]).reshape(-1, len(languages))
    return Model(languages, idf, weights, np.frombuffer(fitted["bias"]), fitted["temperature"])


def predict(docs: DataFrame, model: Model, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with a predicted language and its score, called ``names``; only the text is looked at.

    A text that is null or without a letter is ``und`` with score 0, as is every text if nothing was learned.
    Repeated rows are predicted one by one; the first language in order wins ties. Columns that
    have one of the new names give way.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*(c for c in docs.columns if c not in names))
    columns = kept.columns

    def apply(batch):
        found = [sent.value.predict(text.as_py()) for text in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in columns), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=[*columns, *names],
        )

    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return map_arrow(kept, apply, T.StructType([*kept.schema.fields, *fields]))


def identify(docs: DataFrame) -> DataFrame:
    """Train on ``docs`` and predict every row: ``doc_id, held_out, lang_pred, score``. An empty table gives no rows."""
    done = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs))
    return done.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least_score: float) -> DataFrame:
    """Rows of ``docs`` with a predicted language of at least ``least_score``; the others are rejected.

    Null texts and texts without a letter are rejected, and so is every text if nothing was learned. Texts of any length are read whole. Repeated
    rows, and rows that share an id, are judged one by one. Columns stay as they are, whatever their names; an empty table gives no rows.
    """
    names = ("_lang_pred", "_score")
    while set(names) & set(docs.columns):
        names = tuple(f"_{n}" for n in names)
    done = predict(docs, train(docs), names)
    return done.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least_score)).select(docs.columns)
