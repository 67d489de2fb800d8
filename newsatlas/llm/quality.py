"""Quality classification by regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, words_of

#: The statistics, in order; all are transformed to be roughly bell-shaped.
FEATURES = (
    "log_words",
    "log_word_length",
    "log_word_length_spread",
    "distinct_words",
    "repeated_neighbours",
    "word_entropy",
    "upper_share",
    "digit_share",
    "mark_share",
    "odd_mark_share",
    "words_ending_odd",
    "lone_marks",
    "log_line_words",
    "repeated_lines",
    "sentence_ends",
    "compression",
)
#: Weight of the pooled covariance in each class's own, and of its diagonal in that.
SHRINK_TO_POOLED, SHRINK_TO_DIAGONAL = 0.2, 0.1
_MARKS = bytes(set(range(33, 127)) - set(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
_ODD = b"#$%&*+<=>@\\^_`{|}~!"
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_SENTENCE = re.compile(rb"[.!?](?=\s|$)")


def _share(part: float, whole: float, at_least: float = 4.0) -> float:
    """A share on the scale of log odds, with a little added to both sides."""
    return math.log((part + 0.5) / (max(whole - part, 0) + at_least))


def statistics(text: bytes | None) -> list[float]:
    """The transformed statistics of a whole text; a null is an empty text."""
    text = text or b""
    words, size = words_of(text), len(text)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    f = np.fromiter(counts.values(), np.float64, len(counts))
    entropy = float(np.log(max(n, 1)) - (f * np.log(f)).sum() / n) if n else 0.0
    count_of = lambda signs: size - len(text.translate(None, signs))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        math.log1p(n),
        math.log1p(lengths.mean() if n else 0.0),
        math.log1p(lengths.std() if n else 0.0),
        _share(len(counts), n),
        _share(sum(map(bytes.__eq__, words, words[1:])), n),
        entropy,
        _share(count_of(_UPPER), size),
        _share(count_of(_DIGITS), size),
        _share(count_of(_MARKS), size),
        _share(count_of(_ODD), size),
        _share(sum(w[-1] in _ODD for w in words), n),
        _share(sum(len(w) == 1 and w in _MARKS for w in words), n),
        math.log1p(n / max(1, len(lines))),
        _share(len(lines) - len(set(lines)), len(lines)),
        _share(len(_SENTENCE.findall(text)), n),
        math.log1p(len(counts) / max(1.0, n**0.7)),
    ]


def _measure(batches):
    for rows in chunks(batches, ["doc_id", "text"], most=4_000_000):
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([i for i, _ in rows], pa.int64()),
                "x": pa.array([statistics(t) for _, t in rows], pa.list_(pa.float64())),
            }
        )


def measured(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, x): the statistics of each whole text, in order of ``FEATURES``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_measure, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, lower Cholesky factors and log priors of the classes 0 and 1, over standardised statistics."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    log_priors: np.ndarray


def _moments(batches):
    """Per task and class the count, the sums and the sums of products."""
    k = len(FEATURES)
    sums = {c: (0, np.zeros(k), np.zeros((k, k))) for c in (0, 1)}
    for batch in batches:
        quality = batch.column("quality").to_numpy(zero_copy_only=False)
        x = np.array(batch.column("x").to_pylist(), np.float64).reshape(-1, k)
        for c in (0, 1):
            own = x[quality == c]
            n, s, p = sums[c]
            sums[c] = (n + len(own), s + own.sum(axis=0), p + own.T @ own)
    yield pa.RecordBatch.from_pydict(
        {
            "quality": pa.array([0, 1], pa.int32()),
            "n": pa.array([sums[c][0] for c in (0, 1)], pa.int64()),
            "values": pa.array([np.concatenate([sums[c][1], sums[c][2].ravel()]) for c in (0, 1)], pa.list_(pa.float64())),
        }
    )


def fit(labelled: DataFrame, pooled: float = SHRINK_TO_POOLED, diagonal: float = SHRINK_TO_DIAGONAL) -> Discriminant:
    """Fit to rows (x, quality 0 or 1); other values of quality, and nulls, are passed over.

    All rows count. Tasks sum moments, a row for each task and class, and those are summed by Spark; the driver gets a fixed number
    of values. A class's covariance is shrunk towards the pooled one, and that towards its diagonal. A class without
    rows has the pooled mean, so that nothing but the priors (a document added to each class) tells it apart.
    """
    k = len(FEATURES)
    rows = labelled.filter(F.col("quality").isin(0, 1)).select("x", F.col("quality").cast("int").alias("quality"))
    parts = rows.mapInArrow(_moments, "quality int, n long, values array<double>")
    sums = parts.select("quality", "n", F.posexplode("values").alias("at", "v")).groupBy("quality", "at").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v")
    )
    count, first, second = np.zeros(2), np.zeros((2, k)), np.zeros((2, k, k))
    for quality, at, n, v in sums.toPandas()[["quality", "at", "n", "v"]].itertuples(index=False):
        count[quality] = n
        if at < k:
            first[quality, at] = v
        else:
            second[quality, (at - k) // k, (at - k) % k] = v
    total = max(count.sum(), 1.0)
    centre = first.sum(axis=0) / total
    scale = np.sqrt(np.maximum(np.diag(second.sum(axis=0)) / total - centre**2, 1e-6))
    means, covariances = np.zeros((2, k)), np.zeros((2, k, k))
    for c in (0, 1):
        n = max(count[c], 1.0)
        mean = first[c] / n if count[c] else centre
        spread = second[c] / n - np.outer(mean, mean) if count[c] else np.zeros((k, k))
        means[c], covariances[c] = (mean - centre) / scale, spread / np.outer(scale, scale)
    common = (count[:, None, None] * covariances).sum(axis=0) / total
    common = (1 - diagonal) * common + diagonal * np.diag(np.diag(common)) + 0.01 * np.eye(k)
    factors = np.stack([np.linalg.cholesky((1 - pooled) * covariances[c] + pooled * common + 1e-6 * np.eye(k)) for c in (0, 1)])
    return Discriminant(centre, scale, means, factors, np.log((count + 1) / (count.sum() + 2)))


def _scores(shared):
    def run(batches):
        model = shared.value
        # The inverses of the factors are found once for a task.
        inverse = [np.linalg.inv(f) for f in model.factors]
        log_roots = [np.log(np.diag(f)).sum() for f in model.factors]
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
            z = (x - model.centre) / model.scale
            logs = []
            for c in (0, 1):
                distance = ((z - model.means[c]) @ inverse[c].T) ** 2
                logs.append(model.log_priors[c] - log_roots[c] - 0.5 * distance.sum(axis=1))
            score = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(score, pa.float64())})

    return run


def scored(measures: DataFrame, model: Discriminant) -> DataFrame:
    """Rows (doc_id, score): the probability of class 1, from the difference of the two log densities."""
    shared = measures.sparkSession.sparkContext.broadcast(model)  # of a fixed size
    return measures.select("doc_id", "x").mapInArrow(_scores(shared), "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, fold: str = "pmod(crc32(cast(doc_id AS string)), 5) = 0") -> DataFrame:
    """Rows (doc_id, held_out, score), one per row of ``docs`` (doc_id long, text string).

    Labels (doc_id, quality) are learnt from documents for which the SQL condition ``fold`` is false; a null doc_id counts as held out and is
    never learnt from. The score is between 0 and 1, higher for likelier quality, for null and empty texts too.
    A label that comes twice counts once with its smallest quality; repeated documents are scored each. No documents give no rows; without labels every score is
    that of equal priors. Statistics are computed once for each whole text and stored, without it.
    """
    from .common import stored

    held_out = F.coalesce(F.expr(fold), F.lit(True))
    x = stored(measured(docs), "statistics")
    labels = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality")
    )
    model = fit(x.filter(~held_out).join(labels, "doc_id"))
    return scored(x, model).select("doc_id", held_out.alias("held_out"), "score")
