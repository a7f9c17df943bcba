"""Fixtures and plain counterparts shared by the tests of the training-data operators."""

import random

from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def clashing(docs):
    """The documents with columns named like those that operators use inside."""
    names = ["text_hash", "text_hash_", "fp", "root", "component_id", "place_", "bitmap", "keep_bitmap_", "bitmap_id_", "toxic_score_",
             "score", "group_", "offset", "sequence_id", "length", "label", "kept_id_", "pos", "bucket"]
    return docs.select("*", *[F.lit("mine").alias(n) for n in names])


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def collected(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
