"""Filter interaction audit by contracting contingency tensors.

Each document fails or passes five filters. The documents of a part are counted by their pattern of failures, which
gives one 2 x 2 x 2 x 2 x 2 tensor for each part (and one for each label that is weighed). A step of a filter order is a
contraction: along each axis it selects pass, fail or all. ``einsum`` contracts all steps of all orders at once, so
the orders cost nothing on the documents: those are read once and aggregated to at most 32 rows a part.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import materialize

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Most filters that are audited together: all their orders are listed.
MOST_FILTERS = 7
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def few_words(words: Column, text: Column) -> Column:
    return F.size(words) < 200


def repeated_words(words: Column, text: Column) -> Column:
    return 100 * F.size(F.array_distinct(words)) < 50 * F.size(words)


def many_capitals(words: Column, text: Column) -> Column:
    return 100 * (F.length(text) - F.length(F.translate(text, CAPITALS, ""))) > 3 * F.length(text)


def odd_marks(words: Column, text: Column) -> Column:
    return text.rlike("[#$%&*|]")


#: Failure conditions by letter, of (words, text); the last filter, repeated texts, is built in.
CONDITIONS = {"A": few_words, "B": repeated_words, "C": many_capitals, "D": odd_marks}
REPEATED = "E"


def failures(docs: DataFrame, conditions: Mapping = CONDITIONS, part: str = "lang") -> DataFrame:
    """(doc_id, part, fails, text_key) of each row: bits of failed conditions, the first condition highest, and the
    text's SHA-256. One pass over the texts; what follows moves these narrow rows only."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    worded = texts.withColumn("words", F.array_remove(F.split("text", r"[ \t-\r]+"), ""))
    bits = F.lit(0)
    for place, fails in enumerate(conditions.values()):
        bits = bits + F.when(fails(F.col("words"), F.col("text")), 1 << (len(conditions) - 1 - place)).otherwise(0)
    return worded.select("doc_id", "part", bits.alias("fails"), F.unhex(F.sha2("text", 256)).alias("text_key"))


def marked_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with the last bit: 1 if a smaller doc_id has the same text.

    The smallest id of each text is an aggregate, and rows meet it by text and id, so a text that a third of all
    rows share is spread by its ids. A null id neither repeats nor is repeated."""
    firsts = rows.where("doc_id IS NOT NULL").groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    repeats = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return rows.join(firsts, ["text_key", "doc_id"], "left").withColumn("fails", 2 * F.col("fails") + repeats.cast("int")).drop("first", "text_key")


def patterns(docs: DataFrame, labels: DataFrame, conditions: Mapping = CONDITIONS, part: str = "lang") -> DataFrame:
    """(part, fails, n, good, toxic): documents of each part by pattern of failures, with those labelled quality 1 and toxic 1."""
    rows = marked_repeats(materialize(failures(docs, conditions, part), "failures"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    joined = rows.join(marks, "doc_id", "left")
    return joined.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )


def steps_of(names: str) -> tuple[list[tuple[str, int, str]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, step, filter) of every step, and for each step and axis what it selects: for the rows that stay, the rows
    removed, all that fail its filter, those that fail it alone."""
    rows, kept, removed, failing, alone = [], [], [], [], []
    for order in permutations(range(len(names))):
        for step, own in enumerate(order):
            before = order[:step]
            rows.append(("".join(names[i] for i in order), step + 1, names[own]))
            axes = range(len(names))
            kept.append([PASS if i in before or i == own else ALL for i in axes])
            removed.append([FAIL if i == own else PASS if i in before else ALL for i in axes])
            failing.append([FAIL if i == own else ALL for i in axes])
            alone.append([FAIL if i == own else PASS for i in axes])
    return rows, *(np.array(x, np.int64) for x in (kept, removed, failing, alone))


def contract(tensors: np.ndarray, selected: np.ndarray) -> np.ndarray:
    """Sums of each tensor (first axis) over what each step selects along the other axes: (step, tensor)."""
    axes = "abcdefg"[: tensors.ndim - 1]
    operands = ",".join("s" + a for a in axes)
    return np.einsum(f"v{axes},{operands}->sv", tensors, *(selected[:, i] for i in range(len(axes))), optimize=True)


def audit_part(fails: np.ndarray, counts: np.ndarray, names: str) -> tuple[list[tuple[str, int, str]], dict[str, np.ndarray]]:
    """Every step of every order and its counts; ``counts`` has a row for each pattern: documents, good, toxic."""
    flat = np.zeros((3, 2 ** len(names)), np.int64)
    np.add.at(flat, (slice(None), fails), counts.T)
    tensors = flat.reshape(3, *(2,) * len(names))
    rows, kept, removed, failing, alone = steps_of(names)
    gone = contract(tensors, removed)
    of_filter = np.array([names.index(own) for _, _, own in rows])
    found = {
        "kept": contract(tensors, kept)[:, 0],
        "removed": gone[:, 0],
        "redundant": contract(tensors, failing)[:, 0] - gone[:, 0],
        "unique_fails": contract(tensors, alone)[:, 0],
        "good_lost": gone[:, 1],
        "toxic_lost": gone[:, 2],
        "shapley": np.bincount(of_filter, gone[:, 0], len(names)).astype(np.int64)[of_filter],
    }
    return rows, found


def audit_filters(docs: DataFrame, labels: DataFrame, conditions: Mapping = CONDITIONS, part: str = "lang") -> DataFrame:
    """One row for each part, filter order and step: ``kept`` after the step, ``removed`` by it, ``redundant`` (failing its
    filter but removed before), ``unique_fails`` (failing its filter only), ``good_lost`` and ``toxic_lost`` (removed here
    with that label) and ``shapley`` (its filter's ``removed`` over all orders).

    ``docs`` has doc_id, text and the part column, ``labels`` doc_id, quality, toxic; other columns are not read. Null
    texts are empty, null parts the empty string. A row with a null id carries no label and is never a repeat. A
    document is good or toxic if any of its labels says so; every one of repeated rows counts. No documents: no rows.
    """
    names = "".join(conditions) + REPEATED
    if len(set(names)) != len(conditions) + 1 or len(names) > MOST_FILTERS:
        raise ValueError(f"conditions need different letters other than {REPEATED}, at most {MOST_FILTERS - 1}")

    def run(rows: pa.Table) -> pa.Table:
        counts = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("n", "good", "toxic")], axis=1)
        steps, found = audit_part(rows.column("fails").to_numpy().astype(np.int64), counts, names)
        orders, numbers, filters = zip(*steps)
        named = pa.array([rows.column("part")[0].as_py()] * len(steps), pa.string())
        columns = [named, pa.array(orders), pa.array(numbers, pa.int32()), pa.array(filters), *(pa.array(found[c], pa.int64()) for c in COUNTS)]
        return pa.table(columns, names=["part", "filter_order", "step", "filter", *COUNTS])

    schema = "part string, filter_order string, step int, filter string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return patterns(docs, labels, conditions, part).groupBy("part").applyInArrow(run, schema)


def rows_for(parts: int, filters: int = len(CONDITIONS) + 1) -> int:
    """Rows of an audit: every part has each order with each of its steps."""
    return parts * math.factorial(filters) * filters
