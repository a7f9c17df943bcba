"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is read in windows of ``WINDOW`` words, each overlapping the next by half. A word's input is
made of learned embedding rows: that of its hashed form, and those of its hashed character n-grams (mean, and
largest and smallest of the first dimension), so that spellings never seen as words still count. The network runs
over a window in both directions, attention pools its states, and the window gets a score; a text scores as
its most toxic window. Labels belong to texts, so training takes the window of each text that scores
highest and follows its gradient (multiple-instance learning) down to the embedding rows, in numpy, in one
task, on a bounded sample of labelled rows. The first dimension starts from counted log odds; those that training
sees for a row come from the other half of the rows, so the network does not learn to trust evidence that a
row gave itself. The second dimension starts at random.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bound_batches, columns_of, id_and_text, in_fold, labelled_sample, one_task, quoted, schema_text, texts_of, unused
from stratalake.llm.subwords import Scan, parts

BUCKETS = 1 << 18
GRAM_SIZES = (4, 5, 6)
WINDOW, STRIDE = 32, 16
HIDDEN, INPUTS = 8, 8
#: Dimensions of an embedding row.
DIMENSIONS = 2
#: Labelled rows of each class that training reads.
ROWS_PER_CLASS = 4000
EPOCHS = 12
#: Windows of a training step.
BATCH = 64
#: Training rounds between two looks at all windows of all texts for the one that scores highest.
LOOK_EVERY = 4
#: Step of the embedding rows, relative to the root of the sum of their squared gradients.
TABLE_RATE = 0.01
THRESHOLD = 0.5
#: Weight of the prior in the evidence of a bucket, in rows.
PRIOR_ROWS = 8.0
#: Windows that the network runs at once.
BLOCK = 2048
#: Words whose projected inputs are held at once.
HELD_WORDS = 1 << 17


def slots(scan: Scan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of the words, and of the n-grams with their words."""
    mask = np.uint64(BUCKETS - 1)
    words = (scan.words & mask).astype(np.int64)
    hashes = np.concatenate([h for h, _ in scan.grams]) & mask
    owners = np.concatenate([w for _, w in scan.grams])
    return words, hashes.astype(np.int64), owners


def evidence(seen: np.ndarray, toxic: np.ndarray, prior: float) -> np.ndarray:
    """Log odds of label 1 for each bucket against the prior, from the rows that hold it."""
    share = (toxic + PRIOR_ROWS * prior) / (seen + PRIOR_ROWS)
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return (np.log(share / (1 - share)) - np.log(prior / (1 - prior))).astype(np.float32)


class WordInputs:
    """Inputs of each word of a scan, (words, INPUTS): first dimension of the word's row; mean, largest and smallest first
    dimension of its n-grams' rows; length; one; second dimension of the word's row, and its mean over the n-grams.

    ``read(kind, dimension, slots, words)`` gives values of embedding rows (kind 0: words, 1: n-grams) that belong to the
    scan's words of these numbers."""

    def __init__(self, scan: Scan, read):
        self.words, grams, owners = slots(scan)
        count = len(self.words)
        self.inputs = np.zeros((count, INPUTS), np.float32)
        if not count:
            self.grams, self.owners = grams, owners
            return
        order = np.argsort(owners, kind="stable")
        self.grams, self.owners = grams[order], owners[order]
        self.counts = np.bincount(owners, minlength=count)
        self.held = np.flatnonzero(self.counts)
        self.firsts = (np.cumsum(self.counts) - self.counts)[self.held]
        every, out = np.arange(count), self.inputs
        self.values = read(1, 0, self.grams, self.owners).astype(np.float32, copy=False)
        out[:, 0] = read(0, 0, self.words, every)
        out[:, 1] = np.bincount(self.owners, self.values, count) / np.maximum(self.counts, 1)
        if len(self.held):
            out[self.held, 2] = np.maximum.reduceat(self.values, self.firsts)
            out[self.held, 3] = np.minimum.reduceat(self.values, self.firsts)
        out[:, 4] = np.minimum(scan.lengths, 24) / 12
        out[:, 5] = 1
        out[:, 6] = read(0, 1, self.words, every)
        out[:, 7] = np.bincount(self.owners, read(1, 1, self.grams, self.owners), count) / np.maximum(self.counts, 1)

    def back(self, gradient: np.ndarray) -> list[list[np.ndarray]]:
        """Gradients of the values read, by kind and dimension, from those of the inputs. Equal extremes share theirs."""
        g = gradient[self.owners] / np.maximum(self.counts, 1)[self.owners, None]
        first = g[:, 1]
        for column in (2, 3):
            extreme = self.values == self.inputs[self.owners, column]
            ties = np.bincount(self.owners, extreme, len(self.words))
            first = first + np.where(extreme, gradient[self.owners, column] / np.maximum(ties, 1)[self.owners], 0)
        return [[gradient[:, 0], gradient[:, 6]], [first, g[:, 7]]]


def word_inputs(scan: Scan, tables: np.ndarray) -> np.ndarray:
    """Inputs by ``tables`` (kind, dimension, bucket)."""
    return WordInputs(scan, lambda kind, dimension, rows, words: tables[kind, dimension][rows]).inputs


def windows(count: int) -> np.ndarray:
    """First word of each window of a text of ``count`` words: every ``STRIDE`` words, the last one at its end."""
    if count <= WINDOW:
        return np.zeros(min(count, 1), np.int64)
    return np.append(np.arange(0, count - WINDOW, STRIDE), count - WINDOW)


class Network:
    """Weights of the network; forward and backward passes over windows of inputs."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.weights = {
            "inputs": draw(2, INPUTS, 3 * HIDDEN),
            "states": draw(2, HIDDEN, 3 * HIDDEN),
            "attention": draw(2 * HIDDEN),
            "output": draw(2 * HIDDEN),
            "bias": np.array([-2.0], np.float32),
        }

    def forward(self, projected: np.ndarray, mask: np.ndarray | None, keep: bool = False):
        """Scores of windows; ``projected`` is (WINDOW, 2, windows, 3 * HIDDEN), step t of the second
        direction being word WINDOW - 1 - t; ``mask`` (WINDOW, windows) is 1 where there is a word."""
        w = self.weights
        count = projected.shape[2]
        h = np.zeros((2, count, HIDDEN), np.float32)
        states = np.empty((WINDOW, 2, count, HIDDEN), np.float32)
        tape = []
        for t in range(WINDOW):
            x, u = projected[t], np.matmul(h, w["states"])
            gates = np.tanh((x[..., : 2 * HIDDEN] + u[..., : 2 * HIDDEN]) * np.float32(0.5))
            gates += 1
            gates *= np.float32(0.5)
            z, r = gates[..., :HIDDEN], gates[..., HIDDEN:]
            n = np.tanh(x[..., 2 * HIDDEN :] + r * u[..., 2 * HIDDEN :])
            new = n + z * (h - n)
            if mask is not None:
                m = np.stack([mask[t], mask[WINDOW - 1 - t]])[..., None]
                new = h + m * (new - h)
            if keep:
                tape.append((h, z, r, n, u[..., 2 * HIDDEN :]))
            h = new
            states[t, 0], states[WINDOW - 1 - t, 1] = h[0], h[1]
        left, right = w["attention"][:HIDDEN], w["attention"][HIDDEN:]
        energy = states[:, 0] @ left + states[:, 1] @ right
        if mask is not None:
            energy = np.where(mask > 0, energy, np.float32(-30))
        share = np.exp(energy - energy.max(axis=0))
        share /= share.sum(axis=0)
        value = states[:, 0] @ w["output"][:HIDDEN] + states[:, 1] @ w["output"][HIDDEN:]
        scores = (share * value).sum(axis=0) + w["bias"][0]
        return (scores, states, share, value, tape) if keep else scores

    def gradients(self, inputs: np.ndarray, mask: np.ndarray, labels: np.ndarray, costs: np.ndarray):
        """Loss gradients over windows (windows, WINDOW, INPUTS) by back-propagation through time: those of the weights, and of
        the inputs as ``x``."""
        w, count = self.weights, len(labels)
        steps = np.stack([inputs.transpose(1, 0, 2), inputs[:, ::-1].transpose(1, 0, 2)], axis=1)
        scores, states, share, value, tape = self.forward(np.matmul(steps, w["inputs"]), mask, keep=True)
        d_score = ((1 / (1 + np.exp(-scores)) - labels) * costs / count).astype(np.float32)
        out = {name: np.zeros_like(v) for name, v in w.items()}
        out["bias"][0] = d_score.sum()
        d_value = share * d_score
        pooled = (share * value).sum(axis=0)
        d_energy = share * (value - pooled) * d_score * (mask > 0)
        d_states = np.empty_like(states)
        for side, part in enumerate((slice(0, HIDDEN), slice(HIDDEN, None))):
            out["output"][part] = np.einsum("tb,tbh->h", d_value, states[:, side])
            out["attention"][part] = np.einsum("tb,tbh->h", d_energy, states[:, side])
            d_states[:, side] = d_value[..., None] * w["output"][part] + d_energy[..., None] * w["attention"][part]
        d_h = np.zeros((2, count, HIDDEN), np.float32)
        out["x"] = np.zeros((count, WINDOW, INPUTS), d_score.dtype)
        backwards = w["inputs"].transpose(0, 2, 1)
        for t in reversed(range(WINDOW)):
            h, z, r, n, u = tape[t]
            d_h = d_h + np.stack([d_states[t, 0], d_states[WINDOW - 1 - t, 1]])
            m = np.stack([mask[t], mask[WINDOW - 1 - t]])[..., None]
            d_new, d_h = d_h * m, d_h * (1 - m)
            d_n = d_new * (1 - z) * (1 - n * n)
            d_z = d_new * (h - n) * z * (1 - z)
            d_r = d_n * u * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_n], axis=-1)
            d_u = np.concatenate([d_z, d_r, d_n * r], axis=-1)
            out["inputs"] += np.matmul(steps[t].transpose(0, 2, 1), d_x)
            d_step = np.matmul(d_x, backwards)
            out["x"][:, t] += d_step[0]
            out["x"][:, WINDOW - 1 - t] += d_step[1]
            out["states"] += np.matmul(h.transpose(0, 2, 1), d_u)
            d_h = d_h + d_new * z + np.matmul(d_u, w["states"].transpose(0, 2, 1))
        return out

    def text_scores(self, inputs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score, first word of the highest window) of each text, from the word inputs of all texts in a row.

        Texts are taken together up to ``HELD_WORDS`` words, as their projected inputs are the largest arrays here."""
        ends = np.cumsum(counts)
        best, place, at = np.empty(len(counts), np.float32), ends - counts, 0
        while at < len(counts):
            begin = ends[at] - counts[at]
            to = max(at + 1, int(np.searchsorted(ends, begin + HELD_WORDS, side="right")))
            best[at:to], local = self._scores(inputs[begin : ends[to - 1]], counts[at:to])
            place[at:to] = local + begin
            at = to
        return best, place

    def _scores(self, inputs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        flat = self.weights["inputs"].transpose(1, 0, 2).reshape(INPUTS, -1)
        projected = inputs @ flat
        offsets = np.cumsum(counts) - counts
        best = np.full(len(counts), self.weights["bias"][0], np.float32)
        place = offsets.copy()
        for short in (False, True):
            texts = np.flatnonzero((counts > 0) & ((counts < WINDOW) == short))
            if not len(texts):
                continue
            starts = [windows(int(counts[i])) for i in texts]
            owner = np.repeat(texts, [len(s) for s in starts])
            first = np.concatenate(starts) + offsets[owner]
            blocks = [slice(at, at + BLOCK) for at in range(0, len(first), BLOCK)]
            scores = np.concatenate([self._block(projected, first[b], counts[owner[b]], short) for b in blocks])
            order = np.lexsort((-scores, owner))
            top = order[np.flatnonzero(np.diff(owner[order], prepend=-1))]
            best[owner[top]], place[owner[top]] = scores[top], first[top]
        return best, place

    def _block(self, projected, first, counts, short):
        step = np.arange(WINDOW)[:, None]
        rows, mask = first[None, :] + step, None
        if short:
            rows = np.minimum(rows, len(projected) - 1)
            mask = (step < counts[None, :]).astype(np.float32)
        x = np.empty((WINDOW, 2, len(first), 3 * HIDDEN), np.float32)
        x[:, 0] = projected[:, : 3 * HIDDEN][rows]
        x[:, 1] = projected[:, 3 * HIDDEN :][rows[::-1]]
        return self.forward(x, mask)


def chosen(inputs: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs (windows, WINDOW, INPUTS) and mask (WINDOW, windows) of windows by first word and end of text."""
    rows = first[:, None] + np.arange(WINDOW)[None, :]
    mask = (rows < end[:, None]).astype(np.float32)
    return inputs[np.minimum(rows, len(inputs) - 1)] * mask[..., None], np.ascontiguousarray(mask.T)


class Tables:
    """Embedding rows while they are trained: counted log odds of each half of the rows, and what training adds to them."""

    def __init__(self, seen: np.ndarray, toxic: np.ndarray, prior: float, rng: np.random.Generator):
        self.whole = evidence(seen.sum(axis=0), toxic.sum(axis=0), prior)
        self.others = np.stack([evidence(seen[1 - k], toxic[1 - k], prior) for k in (0, 1)])
        self.learned = np.zeros((2, DIMENSIONS, BUCKETS), np.float32)
        self.learned[:, 1] = rng.normal(0, 0.1, (2, BUCKETS))
        self.squares = np.zeros_like(self.learned)

    def reader(self, halves: np.ndarray):
        """Values as training sees them, for words whose texts are in these halves."""

        def read(kind, dimension, rows, words):
            values = self.learned[kind, dimension][rows]
            return values + self.others[halves[words], kind, rows] if dimension == 0 else values

        return read

    def step(self, made: WordInputs, gradient: np.ndarray, rate: float):
        """Move the rows that were read, each by its own sum of gradients."""
        for kind, (rows, found) in enumerate(zip((made.words, made.grams), made.back(gradient))):
            held, place = np.unique(rows, return_inverse=True)
            for dimension, values in enumerate(found):
                total = np.bincount(place, values, len(held)).astype(np.float32)
                self.squares[kind, dimension][held] += total * total
                self.learned[kind, dimension][held] -= np.float32(rate) * total / np.sqrt(self.squares[kind, dimension][held] + 1e-8)

    def final(self) -> np.ndarray:
        """The rows for scoring: odds of all rows and what training added."""
        out = self.learned.copy()
        out[:, 0] += self.whole
        return out


def word_starts(text: str) -> np.ndarray:
    """Place of the first character of each word."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    first = ~blank
    first[1:] &= blank[:-1]
    return np.flatnonzero(first).astype(np.int32)


def train(examples: list[tuple[int, str, int]], epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, Network]:
    """(tables, network) from (doc_id, text, label) rows; with one class or no rows all scores are the smoothed prior."""
    examples = sorted(examples)
    texts = [text for _, text, _ in examples]
    labels = np.array([label for _, _, label in examples], np.float32)
    network = Network(seed)
    seen = np.zeros((2, 2, BUCKETS), np.float32)  # half of the rows, words or n-grams
    toxic = np.zeros_like(seen)
    half = np.arange(len(examples)) % 2
    for i, (_, text, label) in enumerate(examples):
        found = [np.zeros(0, np.int64)] * 2
        for held in parts([text]):
            words, grams, _ = slots(Scan(held, GRAM_SIZES))
            found = [np.union1d(found[0], words), np.union1d(found[1], grams)]
        for kind in (0, 1):
            seen[half[i], kind, found[kind]] += 1
            toxic[half[i], kind, found[kind]] += label
    prior = float((labels.sum() + 1) / (len(labels) + 2))
    rng = np.random.default_rng(seed)
    tables = Tables(seen, toxic, prior, rng)
    if len(set(labels.tolist())) < 2:
        network.weights["output"][:] = 0
        network.weights["bias"][0] = np.log(prior / (1 - prior))
        return tables.final(), network
    starts = [word_starts(text) for text in texts]
    counts = np.array([len(s) for s in starts])
    mean, spread = ({k: np.zeros_like(v) for k, v in network.weights.items()} for _ in range(2))
    turn = 0
    worded = np.flatnonzero(counts)
    places = np.zeros(len(counts), np.int64)  # first word of the window that each text trains with

    def look(epoch):
        """The window of each text that scores highest; at first the one with the most evidence."""
        unread, made, owners = [len(text) for text in texts], [], []
        for held in parts(texts):
            scan = Scan(held, GRAM_SIZES)
            made.append(WordInputs(scan, tables.reader(half[scan.doc])).inputs)
            owners.append(scan.doc)
            for index, part in held:
                unread[index] -= len(part)
            if unread[held[-1][0]]:
                continue  # the rest of this text comes with the next parts
            inputs, numbers = np.concatenate(made), np.concatenate(owners)
            some = np.unique(numbers)
            ends = np.cumsum(counts[some])
            if epoch:
                places[some] = network.text_scores(inputs, counts[some])[1] - (ends - counts[some])
            else:
                total = np.append(0, np.cumsum(np.maximum(inputs[:, 0], 0) + np.maximum(inputs[:, 2], 0), dtype=np.float64))
                for i, end in zip(some, ends):
                    first = windows(int(counts[i]))
                    begin = end - counts[i] + first
                    places[i] = first[np.argmax(total[np.minimum(begin + WINDOW, end)] - total[begin])]
            made, owners = [], []

    for epoch in range(epochs):
        if epoch % LOOK_EVERY == 0 or epoch == 1:
            look(epoch)
        for picked in np.array_split(rng.permutation(worded), max(1, len(worded) // BATCH)):
            held = []
            for k, i in enumerate(picked):
                end = places[i] + WINDOW
                held.append((k, texts[i][starts[i][places[i]] : starts[i][end] if end < counts[i] else None]))
            scan = Scan(held, GRAM_SIZES)
            made = WordInputs(scan, tables.reader(half[picked][scan.doc]))
            ends = np.cumsum(np.bincount(scan.doc, minlength=len(picked)))
            x, mask = chosen(made.inputs, np.append(0, ends[:-1]), ends)
            turn += 1
            slowing = 1 - epoch / epochs
            rate = 0.02 * slowing + 0.001
            found = network.gradients(x, mask, labels[picked], np.ones(len(picked), np.float32))
            tables.step(made, found.pop("x")[mask.T > 0], TABLE_RATE * slowing)
            for name, g in found.items():
                mean[name] = 0.9 * mean[name] + 0.1 * g
                spread[name] = 0.99 * spread[name] + 0.01 * g * g
                step = (mean[name] / (1 - 0.9**turn)) / (np.sqrt(spread[name] / (1 - 0.99**turn)) + 1e-6)
                network.weights[name] -= np.float32(rate) * step.astype(np.float32)
    return tables.final(), network


def log_odds(texts: list[str], tables: np.ndarray, network: Network) -> np.ndarray:
    """Log odds of label 1 of whole texts: the highest of all windows; without words the bias alone.
    Very long texts are read in parts; the words from the last window on go along to the next part."""
    best = np.full(len(texts), -np.inf, np.float32)
    unread = [len(text) for text in texts]
    carried = np.zeros((0, INPUTS), np.float32)
    for held in parts(texts):
        scan = Scan(held, GRAM_SIZES)
        counts = np.bincount(scan.doc, minlength=len(texts))
        inputs = np.concatenate([carried, word_inputs(scan, tables)])
        counts[held[0][0]] += len(carried)
        carried = inputs[:0]
        for index, part in held:
            unread[index] -= len(part)
        if unread[index]:  # alone in its list; the window at a text's end comes with the last part
            if len(inputs) < WINDOW:
                carried = inputs
                continue
            last = (len(inputs) - WINDOW) // STRIDE * STRIDE
            carried, inputs = inputs[last:], inputs[: last + WINDOW]
            counts[index] = len(inputs)
        present = np.flatnonzero(counts)
        if len(present):
            scores = network.text_scores(inputs, counts[present])[0]
            best[present] = np.maximum(best[present], scores)
    return np.where(np.isfinite(best), best, network.weights["bias"][0])


def dump(tables: np.ndarray, network: Network) -> bytes:
    file = io.BytesIO()
    np.savez_compressed(file, tables=tables.astype(np.float16), **network.weights)
    return file.getvalue()


def load(blob: bytes) -> tuple[np.ndarray, Network]:
    network = Network()
    with np.load(io.BytesIO(blob)) as saved:
        network.weights = {name: saved[name] for name in network.weights}
        return saved["tables"].astype(np.float32), network


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> tuple[bytes, float]:
    """(model, shift of the log odds that restores the class shares of all usable labels), trained in one
    task on at most ``rows_per_class`` labelled rows of each class outside the held-out fifth."""
    sample = labelled_sample(docs, labels, "toxic", rows_per_class)

    def run(batches):
        rows = []
        for batch in columns_of(batches):
            rows += zip(batch.column("doc_id").to_pylist(), texts_of(batch), batch.column("label").to_pylist())
        ones = sum(label for *_, label in rows)
        model = dump(*train(rows))
        yield pa.RecordBatch.from_pydict({"model": [model], "ones": [ones], "zeros": [len(rows) - ones]})

    found = one_task(sample, run, "model binary, ones bigint, zeros bigint")
    if found is None:
        return dump(*train([])), 0.0
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~in_fold(F.col("doc_id")))
    share = usable.agg(F.sum("toxic").alias("ones"), F.sum(1 - F.col("toxic")).alias("zeros")).first()
    if not (found.ones and found.zeros):
        return bytes(found.model), 0.0
    return bytes(found.model), float(np.log(share.ones / share.zeros) - np.log(found.ones / found.zeros))


def with_scores(docs: DataFrame, fitted: tuple[bytes, float]) -> tuple[DataFrame, str]:
    """``docs`` with a column of scores from 0 to 1, and its name."""
    bound_batches(docs.sparkSession)
    name = unused(docs, "toxic_score_")
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches):
        blob, shift = model.value
        tables, network = load(blob)
        for batch in columns_of(batches):
            scores = 1 / (1 + np.exp(-np.clip(log_odds(texts_of(batch), tables, network) + shift, -60, 60)))
            yield batch.append_column(name, pa.array(scores.astype(np.float64)))

    return docs.mapInArrow(run, schema_text(docs, f"`{name}` double")), name


def score_toxicity(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs(doc_id, text)``, from ``labels(doc_id, toxic)``.

    Only the text is an input of the score. Null and blank texts score the network's bias. Rows of
    ``labels`` with a null id or label, or a label other than 0 and 1, are not used; without any
    usable label all scores are one half. A null doc_id counts as held out. Repeated rows are each scored.
    """
    scored, score = with_scores(id_and_text(docs), fit(docs, labels, rows_per_class))
    return scored.select(
        "doc_id", in_fold(F.col("doc_id")).alias("held_out"), F.col(score).alias("score"),
        F.when(F.col(score) >= threshold, 1).otherwise(0).alias("predicted"),
    )


def reject_toxic(docs: DataFrame, fitted: tuple[bytes, float], threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more by a model of ``fit``; all columns as they are."""
    scored, score = with_scores(docs, fitted)
    return scored.where(F.col(score) < threshold).select(*quoted(docs))
