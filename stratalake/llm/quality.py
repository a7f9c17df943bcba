"""Quality scores from supervised subword embeddings.

Words and character n-grams are hashed to rows of one learned table; a text is the average of the
rows it hits, and a softmax layer gives its class. Table and layer are trained together by
stochastic gradient descent in numpy, on a bounded sample of labelled rows in one task. As the score
is linear in the average, the table is folded to one weight per row before the corpus is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bound_batches, columns_of, id_and_text, in_fold, labelled_sample, one_task, texts_of
from stratalake.llm.subwords import Scan, parts

BUCKETS = 1 << 17
DIMENSIONS = 8
GRAM_SIZES = (3, 4)
#: A word that comes again within so many words is a feature of its own.
REPEATS = 4
#: Labelled rows of each class that training reads.
ROWS_PER_CLASS = 4000
EPOCHS = 8
THRESHOLD = 0.3


def buckets(scan: Scan, size: int = BUCKETS, before: np.ndarray = np.zeros(0, np.uint64)) -> tuple[np.ndarray, np.ndarray]:
    """(table row, index of text) of every feature of a scan; ``before`` are the last words of the text that
    its first part continues, which are repeated but are no features again."""
    mask = np.uint64(size - 1)
    rows = [(scan.words + np.uint64(7)) & mask, *((hashes & mask) for hashes, _ in scan.grams)]
    docs = [scan.doc, *(scan.doc[word] for _, word in scan.grams)]
    words = np.concatenate([before, scan.words])
    owners = np.concatenate([np.full(len(before), scan.first), scan.doc])
    for back in range(1, REPEATS + 1):  # word pairs of equal words share one row for each distance
        again = np.flatnonzero((words[back:] == words[:-back]) & (owners[back:] == owners[:-back])) + back
        again = again[again >= len(before)]
        rows.append(np.full(len(again), back, np.uint64))
        docs.append(owners[again])
    return np.concatenate(rows).astype(np.int64), np.concatenate(docs)


def features(texts: list[str], size: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``buckets`` of all texts, part by part; the last words of a parted text go along to its next part."""
    before, index = np.zeros(0, np.uint64), -1
    for held in parts(texts):
        scan = Scan(held, GRAM_SIZES)
        if scan.first != index:
            before = before[:0]
        yield buckets(scan, size, before)
        before, index = np.concatenate([before, scan.words])[-REPEATS:], held[-1][0]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of a text and their shares."""
    counts = np.zeros(BUCKETS, np.int64)
    for rows, _ in features([text]):
        counts += np.bincount(rows, minlength=BUCKETS)
    rows = np.flatnonzero(counts)
    return rows, (counts[rows] / max(1, counts.sum())).astype(np.float32)


def train(examples: list[tuple[int, str, int]], epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
    """(weight of each table row, bias) of the log odds of label 1, from (doc_id, text, label) rows.

    Classes are drawn as they come; with one class or no rows the weights are 0 and the bias is the smoothed prior.
    """
    examples = sorted(examples)
    features = [document_features(text) for _, text, _ in examples]
    labels = np.array([label for _, _, label in examples], np.int64)
    prior = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    if len(set(labels.tolist())) < 2:
        return np.zeros(BUCKETS, np.float32), prior
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.array([0, prior], np.float32)
    total, turn = epochs * len(examples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            rate = np.float32(0.5 * (1 - turn / total) + 0.01)
            turn += 1
            rows, shares = features[i]
            average = shares @ table[rows] if len(rows) else np.zeros(DIMENSIONS, np.float32)
            scores = average @ layer + bias
            wrong = np.exp(scores - scores.max())
            wrong /= wrong.sum()
            wrong[labels[i]] -= 1
            back = layer @ wrong
            layer -= rate * np.outer(average, wrong)
            bias -= rate * np.float32(0.1) * wrong
            if len(rows):
                # rows of a long text get tiny shares: scaled by their number, as if each feature were a step
                table[rows] -= (rate * min(len(rows), 200)) * shares[:, None] * back[None, :]
    return table @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def log_odds(texts: list[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Log odds of label 1 of whole texts; a text without words gets the bias."""
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
    for rows, docs in features(texts, len(weights)):
        sums += np.bincount(docs, weights[rows], len(texts))
        counts += np.bincount(docs, minlength=len(texts))
    return sums / np.maximum(counts, 1) + bias


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> tuple[np.ndarray, float]:
    """Weights trained in one task on at most ``rows_per_class`` labelled rows of each class outside the
    held-out fifth. The class shares of all usable labels are restored in the bias."""
    sample = labelled_sample(docs, labels, "quality", rows_per_class)

    def run(batches):
        rows = []
        for batch in columns_of(batches):
            rows += zip(batch.column("doc_id").to_pylist(), texts_of(batch), batch.column("label").to_pylist())
        weights, bias = train(rows)
        ones = sum(label for *_, label in rows)
        yield pa.RecordBatch.from_pydict(
            {"weights": [weights.astype("<f4").tobytes()], "bias": [bias], "ones": [ones], "zeros": [len(rows) - ones]}
        )

    schema = "weights binary, bias double, ones bigint, zeros bigint"
    model = one_task(sample, run, schema)
    if model is None:
        return train([])
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~in_fold(F.col("doc_id")))
    share = usable.agg(F.sum("quality").alias("ones"), F.sum(1 - F.col("quality")).alias("zeros")).first()
    shift = 0.0
    if model.ones and model.zeros:
        shift = float(np.log(share.ones / share.zeros) - np.log(model.ones / model.zeros))
    return np.frombuffer(model.weights, "<f4"), model.bias + shift


def score_quality(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs(doc_id, text)``, from ``labels(doc_id, quality)``.

    Only the text is an input of the score. Null and blank texts score the prior alone. Rows of
    ``labels`` with a null id or label, or a label other than 0 and 1, are not used; without any
    usable label all scores are one half. A null doc_id counts as held out. Repeated rows are each scored.
    """
    bound_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows_per_class))

    def run(batches):
        weights, bias = model.value
        for batch in columns_of(batches):
            scores = 1 / (1 + np.exp(-np.clip(log_odds(texts_of(batch), weights, bias), -60, 60)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    scored = id_and_text(docs).mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    )
