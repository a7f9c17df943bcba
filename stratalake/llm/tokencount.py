"""Token counts by batch encoding in Arrow functions that return lengths only.

Rows are gathered until a byte budget is full, so a batch weighs about the same whether it holds thousands of
notes or one book. Texts are split at boundaries where the tokenizer splits too, whatever stands around them, so a
text's count is the sum over its parts, and parts seen before are not encoded again. New parts go to the
library in batches that are balanced by bytes as well. Only numbers leave the Python workers.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import bound_batches, columns_of, id_and_text, worker_cache

#: Token count above which a document is marked.
LIMIT = 2048
#: Bytes of text in one group of rows.
GROUP_BYTES = 4 << 20
#: Bytes of new parts in one call of the library.
CALL_BYTES = 1 << 20
#: Bytes of parts (with about 150 more for each) whose counts a worker remembers before it starts anew.
HELD_BYTES = 96 << 20
PART_COST = 150

#: White space on which Python and the tokenizers agree.
BLANKS = re.compile(r"[^\S\x1c-\x1f]+")
ODD_BLANKS = re.compile(r"[\x1c-\x1f]")
#: One mark that ends a clause: parted from the letter or digit before it.
CLAUSE_END = re.compile(r"[.,;:!?](?<=[A-Za-z0-9].)(?=\s|\Z)")
#: Before a single blank between ASCII letters or digits.
WORD_GAP = re.compile(r"(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")


def blank_parts(text: str) -> list[str]:
    """Parts of a text for files that drop white space between words: cut at white space and before clause ends."""
    text = CLAUSE_END.sub(r" \g<0>", text)
    return text.split() if ODD_BLANKS.search(text) is None else [part for part in BLANKS.split(text) if part]


def gap_parts(text: str) -> list[str]:
    """Parts for byte-level files, where a blank belongs to the word behind it."""
    return WORD_GAP.split(text) if text else []


def piece_parts(text: str) -> list[str]:
    """Parts for sentence pieces that never cross a blank; the library puts the blank back in front of each."""
    first, *others = gap_parts(text) or [""]
    return [first, *(part[1:] for part in others)] if text else []


def whole(text: str) -> list[str]:
    return [text] if text else []


def drops_blanks(spec: dict) -> bool:
    """The file keeps the matches of a pattern and drops white space, cases and compositions by single characters."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    names = [step["type"] for step in (spec.get("normalizer") or {}).get("normalizers", [])]
    kept = [step for step in steps if step["type"] == "Split" and step["invert"] and step["behavior"] == "Removed"]
    return bool(kept) and kept[0]["pattern"].get("Regex", "").endswith(r"[^\s\p{L}\p{N}]+") and set(names) <= {"NFC", "Replace", "Lowercase"}


def byte_level(spec: dict) -> bool:
    return spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and spec["pre_tokenizer"]["use_regex"]


def plain_special(spec: dict) -> bool:
    """No special token holds a blank, a clause end behind a letter, or takes in its surroundings."""
    return not any(
        re.search(r"\s", t["content"]) or CLAUSE_END.search(t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"]
        for t in spec["added_tokens"]
    )


def library(content: bytes, kind: str) -> tuple[Callable[[list[str]], list[int]], Callable[[str], list[str]]]:
    """(counts of a list of texts, parts of a text) of a ``.json`` file (tokenizers) or a ``.model`` file (sentencepiece).
    Files of another make than the known ones are given whole texts."""
    if kind == ".model":
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_proto=content)
        crossing = any("▁" in own.id_to_piece(i).lstrip("▁") for i in range(own.get_piece_size()))
        return lambda texts: [len(ids) for ids in own.encode(texts, num_threads=1)], whole if crossing else piece_parts
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    spec = json.loads(content)
    own = Tokenizer.from_str(content.decode())
    own.no_truncation()
    own.no_padding()
    parts = whole
    if plain_special(spec):
        parts = blank_parts if drops_blanks(spec) else gap_parts if byte_level(spec) else whole
    return lambda texts: [len(e) for e in own.encode_batch_fast(texts, add_special_tokens=False)], parts


class PartCounts:
    """Token counts of texts; counts of parts are remembered up to ``held_bytes``."""

    def __init__(self, content: bytes, kind: str, held_bytes: int = HELD_BYTES):
        self.counts_of, self.parts_of = library(content, kind)
        self.held_bytes, self.held, self.known = held_bytes, 0, {}

    def learn(self, parts: set[str]):
        """Encode these parts, in calls of about ``CALL_BYTES``."""
        call, size = [], 0
        for part in parts:
            call.append(part)
            weight = len(part.encode())
            size += weight
            self.held += weight + PART_COST
            if size >= CALL_BYTES:
                self.known.update(zip(call, self.counts_of(call)))
                call, size = [], 0
        if call:
            self.known.update(zip(call, self.counts_of(call)))

    def count(self, texts: list[str]) -> list[int]:
        parted = [self.parts_of(text) for text in texts]
        self.learn({part for part in chain.from_iterable(parted) if part not in self.known})
        counts = [sum(map(self.known.__getitem__, parts)) for parts in parted]
        if self.held > self.held_bytes:
            self.known, self.held = {}, 0
        return counts


def groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[str], list[int]]]:
    """(ids, texts, bytes) of rows until their texts have ``size`` bytes."""
    ids, texts, sizes, held = [], [], [], 0
    for batch in columns_of(batches):
        for doc_id, text, n_bytes in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "text", "n_bytes"))):
            ids.append(doc_id)
            texts.append(text)
            sizes.append(n_bytes)
            held += n_bytes
            if held >= size:
                yield ids, texts, sizes
                ids, texts, sizes, held = [], [], [], 0
    if ids:
        yield ids, texts, sizes


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of ``docs(doc_id, text)``.

    Counts are those of the library for the whole text, without begin, end or added special tokens; strings of
    special tokens inside a text count as the library's default has it. Null and empty texts have no bytes and no
    tokens. Ids may be null or repeated, each row is counted; other columns are not read. The file is read on the
    driver and sent along, so executors need no copy of it.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    content = Path(tokenizer_path).read_bytes()
    kind = Path(tokenizer_path).suffix
    key = ("token counts", kind, hashlib.sha256(content).hexdigest())
    sent = spark.sparkContext.broadcast(content)

    def run(batches):
        counter = worker_cache(key, lambda: PartCounts(sent.value, kind))
        for ids, texts, sizes in groups(batches, GROUP_BYTES):
            counts = counter.count(texts)
            arrays = [pa.array(c, pa.int64()) for c in (ids, sizes, counts)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([n > limit for n in counts])], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    texts = id_and_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sized = texts.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    return sized.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
