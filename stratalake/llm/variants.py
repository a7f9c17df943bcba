"""Spelling variants by one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols. Words at one edit (an inserted, deleted or replaced code point) have reduced
words at one edit or none, so the reduced vocabulary is joined with the one-edit neighbourhoods of its own words, and
the pairs that meet are verified on the original strings. Every edge of the neighbourhoods is generated once, from
its longer word or from the one whose changed symbol is smaller, and counts for both ends.

Reduced words travel as 64-bit hashes of their symbols, which an edit changes by a closed formula; equal hashes of
different reduced words only cost a verification.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bound_batches, columns_of, id_and_text, materialize, texts_of

#: Shortest word, in code points, and fewest occurrences.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form is at least so many times as frequent as its variant.
FORM_FACTOR = 10
#: One of so many runs of a document loses a code point.
DELETED_OF = 31
#: Distinct words whose counts a task holds before it hands them on.
HELD_WORDS = 400_000
#: Mean number of the shortest words for each reduced word, which sets the number of symbols.
WORDS_PER_KEY = 32
#: Words up to this length travel themselves, longer ones by digest.
LONG = 64
#: Rows of neighbours made at once.
ROWS_AT_ONCE = 200_000

RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def lowered(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def counted(doc_id: int | None, text: str) -> Counter:
    """Words of a document with their numbers; one of ``DELETED_OF`` runs, by a hash with the id, loses a code point."""
    runs = Counter(RUN.findall(lowered(text)))
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    edited = []
    for run in runs:
        h = zlib.crc32(run.encode(), prefix)
        if h % DELETED_OF == 0:
            edited.append((run, h % len(run)))
    moved = [(run[:at] + run[at + 1 :], runs.pop(run)) for run, at in edited]
    for word, n in moved:
        if len(word) >= LEAST_LENGTH:
            runs[word] += n
    return runs


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of every word with at least ``LEAST_COUNT`` occurrences; counts are summed in the tasks first."""
    bound_batches(docs.sparkSession)

    def run(batches):
        held = Counter()
        for batch in columns_of(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                for word, n in counted(doc_id, text).items():
                    held[word] += n
            if len(held) >= HELD_WORDS:
                yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
                held = Counter()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    words = id_and_text(docs).mapInArrow(run, "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def symbols_for(words: int) -> int:
    """Symbols that leave about ``WORDS_PER_KEY`` of ``words`` words for each reduced word of the least length."""
    return max(3, int(np.ceil((words / WORDS_PER_KEY) ** (1 / LEAST_LENGTH))))


def reduced(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Symbol (from 1) of each code point."""
    mixed = codes.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(33)) % np.uint64(symbols) + np.uint64(1)


def powers(count: int) -> np.ndarray:
    out = np.full(count, np.uint64(BASE))
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def finished(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of reduced words of one length, mixed."""
    mixed = (hashes + np.uint64(length)) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def neighbours(values: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key of each word itself, keys of its neighbours, which of those count) for words of one length, as rows of symbols.

    Neighbours: each symbol replaced by each larger one, and each symbol deleted; a key that repeats in its row counts once."""
    words, length = values.shape
    power = powers(length + 1)
    terms = values * power[:length]
    before = np.concatenate((np.zeros((words, 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)), axis=1)
    own = before[:, -1]
    made, counts = [], []
    for symbol in range(2, symbols + 1):
        made.append(finished(own[:, None] + (np.uint64(symbol) - values) * power[:length], length))
        counts.append(values < symbol)
    after = own[:, None] - before[:, 1:]
    made.append(finished(before[:, :-1] + after * np.uint64(INVERSE), length - 1))
    # deleting either of two equal neighbours gives the same word
    counts.append(np.concatenate((np.ones((words, 1), bool), values[:, 1:] != values[:, :-1]), axis=1))
    return finished(own, length), np.concatenate(made, axis=1), np.concatenate(counts, axis=1)


def by_length(words: list[str]):
    """(places, code points as rows) of the words of each length, at most about ``ROWS_AT_ONCE`` code points each."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths).tolist():
        every = np.flatnonzero(lengths == length)
        for places in np.array_split(every, max(1, -(-len(every) * length // ROWS_AT_ONCE))):
            codes = np.frombuffer("".join([words[i] for i in places]).encode("utf-32-le"), "<u4")
            yield places, codes.reshape(len(places), length)


def keyed(words: DataFrame, symbols: int, spread: bool) -> DataFrame:
    """(key, same, name, n) of ``words(word, name, n)``: the key of each reduced word, and with ``spread`` also those of its neighbours."""

    def run(batches):
        for batch in columns_of(batches):
            texts = batch.column("word").to_pylist()
            name, n = batch.column("name"), batch.column("n")
            for places, codes in by_length(texts):
                own, near, counts = neighbours(reduced(codes, symbols), symbols)
                rows, keys, same = places, own, np.ones(len(places), bool)
                if spread:
                    at, column = np.nonzero(counts)
                    rows = np.concatenate((rows, places[at]))
                    keys = np.concatenate((keys, near[at, column]))
                    same = np.concatenate((same, np.zeros(len(at), bool)))
                for start in range(0, len(rows), ROWS_AT_ONCE):
                    cut = slice(start, start + ROWS_AT_ONCE)
                    picked = pa.array(rows[cut])
                    arrays = [pa.array(keys[cut].view(np.int64)), pa.array(same[cut]), name.take(picked), n.take(picked)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["key", "same", "name", "n"])

    return words.mapInArrow(run, "key bigint, same boolean, name string, n bigint")


def meeting(words: DataFrame, symbols: int) -> DataFrame:
    """(name, n, near, near_n): pairs of words whose reduced words are at one edit or equal, each pair once."""
    left = keyed(words, symbols, True)
    right = keyed(words, symbols, False).select("key", F.col("name").alias("near"), F.col("n").alias("near_n"))
    once = ~F.col("same") | (F.col("name") < F.col("near"))
    return left.join(right, "key").where(once).select("name", "n", "near", "near_n")


def near_pairs(words: DataFrame, symbols: int, longest: int) -> DataFrame:
    """(word, n, near, near_n): pairs of ``words(word, n)`` at one edit, each once. ``longest``: length of the longest word."""
    one_edit = lambda a, b: F.levenshtein(a, b, 1) == 1
    short = words.where(F.length("word") <= LONG).select("word", F.col("word").alias("name"), "n")
    pairs = meeting(short, symbols).where(one_edit(F.col("name"), F.col("near"))).withColumnRenamed("name", "word")
    if longest <= LONG:
        return pairs
    # a long word has neighbours by the thousand: they carry its digest, and what meets gets its strings back
    long = words.where(F.length("word") >= LONG).select("word", F.sha2("word", 256).alias("name"), "n")
    met = meeting(long, symbols)
    first = long.select(F.col("word"), F.col("name"))
    second = long.select(F.col("word").alias("near_word"), F.col("name").alias("near"))
    strings = met.join(first, "name").join(second, "near").where(F.greatest(F.length("word"), F.length("near_word")) > LONG)
    found = strings.where(one_edit(F.col("word"), F.col("near_word"))).select("word", "n", F.col("near_word").alias("near"), "near_n")
    return pairs.unionByName(found)


def with_forms(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of ``words(word, n)``."""
    size, longest = words.agg(F.count("*"), F.coalesce(F.max(F.length("word")), F.lit(0))).first()
    pairs = near_pairs(words, symbols_for(size), longest)
    ends = F.array(F.struct("word", F.col("near").alias("near"), F.col("near_n").alias("near_n")), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    both = pairs.select(F.explode(ends).alias("e")).select("e.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    fits = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last word on the way over forms.

    Each round doubles the steps taken; counts grow by ``FORM_FACTOR`` a step, so few rounds are needed."""
    links = materialize(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "links")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "links")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def group_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least ``LEAST_LENGTH`` code points that occurs at least ``LEAST_COUNT`` times.

    Words are runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case; see ``counted``. ``n_near`` counts the words at
    one edit, ``form`` is the most frequent of them (ties: the smallest) if it is ``FORM_FACTOR`` times as frequent,
    ``root`` the last word on the way over forms (the word itself without one). Null texts have no words; a null id counts as
    empty text in the hash; every one of repeated rows counts. No documents: no rows. Other columns are not read.
    """
    formed = materialize(with_forms(materialize(vocabulary(docs), "words")), "forms")
    found = formed.join(roots(formed), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
