"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, mixed

#: Hash buckets, n-gram sizes and the count added to every bucket.
BUCKETS, ORDERS, SMOOTHING = 1 << 16, (1, 2, 3), 0.5
UNKNOWN = "und"


@dataclass(frozen=True)
class NaiveBayes:
    """``logs[bucket, class]`` are log probabilities; there is a column per class, in order of ``classes``."""

    classes: tuple[str, ...]
    priors: np.ndarray
    logs: np.ndarray
    orders: tuple[int, ...]


def ngram_buckets(texts: list[str], orders: tuple[int, ...], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram size the buckets of all texts' n-grams, text after text, and where each text's begin.

    Texts are lower-cased and stand between spaces; every ASCII sign that is no letter counts as a space. No n-gram reaches
    into another text, and each text has one at least.
    """
    longest = max(orders)
    blocks = [f" {t.lower()}{' ' * longest}" for t in texts]
    codes = np.frombuffer("".join(blocks).encode("utf-32-le"), "<u4")
    ends = np.cumsum(np.fromiter(map(len, blocks), np.int64, len(blocks)))
    starts = np.concatenate([[0], ends[:-1]])
    codes = np.where((codes >= 128) | ((codes >= 97) & (codes <= 122)), codes, 32).astype(np.uint64)
    inside = np.ones(len(codes), bool)
    out, joined = [], codes
    for n in range(1, longest + 1):
        if n > 1:
            inside[ends - n + 1] = False
            joined = joined[:-1] * np.uint64(1 << 21) + codes[n - 1 :]
        if n in orders:
            h = (mixed(joined + np.uint64(n)) >> np.uint64(40)).astype(np.int64) % buckets
            out.append((h[inside[: len(h)]], starts - (n - 1) * np.arange(len(texts))))
    return out


def _counts(orders, buckets):
    def count(batches):
        """Per task and class one array of counts, as far as it isn't zero."""
        totals: dict[str, np.ndarray] = {}
        documents: dict[str, int] = {}
        for rows in chunks(batches, ["text", "lang"], most=2_000_000):
            by_class: dict[str, list[str]] = {}
            for text, lang in rows:
                by_class.setdefault(lang, []).append(text.decode())
            for lang, texts in by_class.items():
                found = totals.setdefault(lang, np.zeros(buckets, np.int64))
                documents[lang] = documents.get(lang, 0) + len(texts)
                for h, _ in ngram_buckets(texts, orders, buckets):
                    found += np.bincount(h, minlength=buckets)
        for lang, found in totals.items():
            used = np.append(np.flatnonzero(found), -1)  # bucket -1 has the number of documents
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(used), pa.string()),
                    "bucket": pa.array(used, pa.int32()),
                    "n": pa.array(np.append(found[used[:-1]], documents[lang]), pa.int64()),
                }
            )

    return count


def train(docs: DataFrame, orders=ORDERS, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> NaiveBayes:
    """Learn from all rows (text, lang) in which neither is null.

    Counts are made in every task, summed by Spark and fetched as a model: at most ``buckets`` numbers per class, however
    many rows there are. Priors are equal for all classes. No rows give a model without classes. A text counts as often as it comes.
    """
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).dropna()
    counted = rows.mapInArrow(_counts(orders, buckets), "lang string, bucket int, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    classes = tuple(sorted(table["lang"].unique()))
    counts = np.full((buckets, len(classes)), smoothing)
    table = table[table["bucket"] >= 0]
    place = {lang: i for i, lang in enumerate(classes)}
    counts[table["bucket"].to_numpy(), table["lang"].map(place).to_numpy(dtype=np.int64)] += table["n"].to_numpy()
    logs = np.log(counts) - np.log(counts.sum(axis=0)) if classes else counts
    return NaiveBayes(classes, np.full(len(classes), -np.log(max(1, len(classes)))), logs, tuple(orders))


def score(texts: list[str], model: NaiveBayes) -> tuple[list[str], np.ndarray]:
    """The likeliest class of each text and its probability; texts without a letter are ``und``, with 0."""
    if not model.classes or not texts:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    total = np.repeat(model.priors[None], len(texts), axis=0)
    for h, starts in ngram_buckets(texts, model.orders, len(model.logs)):
        # Only the rows of the matrix that occur are touched.
        total += np.add.reduceat(model.logs[h], starts, axis=0)
    best = total.argmax(axis=1)
    probability = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
    letters = np.array([any(map(str.isalpha, t)) for t in texts], bool)
    return [model.classes[b] if known else UNKNOWN for b, known in zip(best, letters)], np.where(letters, probability, 0.0)


def _predict(shared):
    def predict(batches):
        for rows in chunks(batches, ["doc_id", "text"], most=1_000_000):
            found, probability = score([(t or b"").decode() for _, t in rows], shared.value)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([i for i, _ in rows], pa.int64()),
                    "lang_pred": pa.array(found, pa.string()),
                    "score": pa.array(probability, pa.float64()),
                }
            )

    return predict


def identified(docs: DataFrame, model: NaiveBayes) -> DataFrame:
    """Rows (doc_id, lang_pred, score), one per row of ``docs`` (doc_id long, text string).

    ``lang_pred`` is a class of the model, or ``und`` with score 0 if the text is null or has no letter, or the model no class; equal
    probabilities go to the first class by name. The whole text is scored. The matrix is broadcast: its size is that of
    the model's buckets and classes. An empty table gives no rows; repeated rows are scored each. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")
