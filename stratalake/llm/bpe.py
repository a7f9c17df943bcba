"""Byte-pair encoding and decoding by an index of pair occurrences.

The words of a task's texts are numbered once. All new distinct words lie one after the other in one
array of symbols with links to their neighbours, and an index maps each pair of neighbouring symbols
that the vocabulary merges to all its positions there. Merges are applied by ascending rank, each to all
positions of its pair at once; the pairs that a merge makes are added to the lists of their ranks. A
merge can only make pairs of higher rank, so this equals merging word by word.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stratalake.llm.common import bound_batches, columns_of, id_and_text, texts_of, worker_cache

WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words that are numbered before the numbering starts anew.
HELD_WORDS = 300_000
#: Code points gathered before their new words are encoded.
HELD_CHARS = 4_000_000


def byte_symbols() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints, else one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in printable}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + i)
    return out


def newer_letters() -> frozenset[str]:
    """Letters and digits that Python's Unicode tables do not know yet, so that libraries may differ on them."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    return frozenset(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")


class Vocabulary:
    """Symbols, merges and special tokens of a word-end BPE file of the tokenizers library."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in {**vocab, **self.special}.items()}
        symbols = byte_symbols()
        self.inner = np.array([vocab[symbols[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[symbols[b] + suffix] for b in range(256)], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = self.left << 32 | self.right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.spec, self.newer = spec, newer_letters()
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for those that never merge."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], -1)


    def library_words(self, text: str) -> list[str]:
        """Words as the library itself parts them."""
        from tokenizers import Tokenizer

        own = worker_cache(("tokenizers", id(self)), lambda: Tokenizer.from_str(json.dumps(self.spec)))
        byte_of = {symbol: b for b, symbol in byte_symbols().items()}
        parted = own.pre_tokenizer.pre_tokenize_str(own.normalizer.normalize_str(text))
        return [bytes(byte_of[c] for c in word).decode() for word, _ in parted]


def words_of(text: str, vocabulary: Vocabulary, by_library: bool = False) -> list[str]:
    """Words and special tokens of a text, normalised as the file says."""
    split = vocabulary.library_words if by_library else lambda part: WORD.findall(normal(part))
    if vocabulary.splitter is None or "<|" not in text:
        return split(text)
    out: list[str] = []
    for part in vocabulary.splitter.split(text):
        out += [part] if part in vocabulary.special else split(part)
    return out


def normal(text: str) -> str:
    """Composed and in lower case, each character by itself. Blanks only part words, so runs of them stay."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def encode_words(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in a row, end of each word in them)."""
    raw = [word.encode() for word in words]
    lengths = np.array([len(r) for r in raw], np.int64)
    codes = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum(lengths)
    symbols = vocabulary.inner[codes]
    symbols[ends - 1] = vocabulary.final[codes[ends - 1]]
    size = len(symbols)
    following = np.arange(1, size + 1)
    following[ends - 1] = -1
    previous = np.arange(-1, size - 1)
    previous[ends - lengths] = -1

    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(places: np.ndarray):
        """Put the pairs that start at these positions on the lists of their ranks."""
        ranks = vocabulary.ranks(symbols[places], symbols[following[places]])
        places, ranks = places[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        for rank, group in zip(ranks[np.concatenate(([0], cuts))].tolist() if len(ranks) else (), np.split(places, cuts)):
            if rank not in index:
                index[rank] = []
                heapq.heappush(active, rank)
            index[rank].append(group)

    add(np.flatnonzero(following >= 0))
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        left, right, made = vocabulary.left[rank], vocabulary.right[rank], vocabulary.made[rank]
        places = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        after = following[places]
        fits = (symbols[places] == left) & (after >= 0)
        fits[fits] = symbols[after[fits]] == right
        places = places[fits]
        if left == right and len(places) > 1:  # overlapping pairs merge from the left
            taken, kept = -1, []
            for place in np.sort(places).tolist():
                if place != taken:
                    kept.append(place)
                    taken = int(following[place])
            places = np.array(kept, np.int64)
        if not len(places):
            continue
        gone = following[places]
        beyond = following[gone]
        symbols[places], symbols[gone] = made, -1
        following[places], following[gone] = beyond, -1
        previous[beyond[beyond >= 0]] = places[beyond >= 0]
        before = previous[places]
        add(np.concatenate((before[before >= 0], places[beyond >= 0])))
    alive = np.flatnonzero(symbols >= 0)
    return symbols[alive], np.searchsorted(alive, ends)


class Encoder:
    """Numbers words, encodes new ones together, and keeps what it has encoded up to ``HELD_WORDS`` words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.reset()

    def reset(self):
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.ids: list[str] = []
        self.tokens: list[str] = []
        self.counts: list[int] = []
        self.newer: set[int] = set()

    def encode_new(self):
        """Ids (as text), decoded tokens and count of ids of each word that has none yet."""
        words = list(self.number)[len(self.ids) :]
        if not words:
            return
        special = self.vocabulary.special
        ids, ends = encode_words([w for w in words if w not in special] or ["a"], self.vocabulary)
        ids, ends = ids.tolist(), iter(ends.tolist())
        start = 0
        for word in words:
            if word in special:
                own = [special[word]]
            else:
                end = next(ends)
                own, start = ids[start:end], end
            self.ids.append(" ".join(map(str, own)))
            self.tokens.append(self.decode(own))
            self.counts.append(len(own))

    def decode(self, ids: list[int]) -> str:
        """As the library decodes with a file that names no decoder: the tokens, parted by blanks."""
        tokens = self.vocabulary.tokens
        return " ".join([tokens[i] for i in ids])


def encode_texts(texts: list[str], encoder: Encoder) -> list[tuple[str, str, int]]:
    """(ids joined by blanks, decoded text, number of ids) of each text."""
    if len(encoder.number) > HELD_WORDS:
        encoder.reset()
    number, vocabulary = encoder.number, encoder.vocabulary
    numbers = [[number[word] for word in words_of(text, vocabulary)] for text in texts]
    encoder.newer |= {number[word] for word in list(number)[len(encoder.ids) :] if not vocabulary.newer.isdisjoint(word)}
    if encoder.newer:
        for i, row in enumerate(numbers):
            if not encoder.newer.isdisjoint(row):
                numbers[i] = [number[word] for word in words_of(texts[i], vocabulary, by_library=True)]
    encoder.encode_new()
    ids, tokens, counts = encoder.ids, encoder.tokens, encoder.counts
    return [(" ".join([ids[i] for i in row]), " ".join([tokens[i] for i in row]), sum([counts[i] for i in row])) for row in numbers]


def chunks(batches, size: int = HELD_CHARS):
    """(ids, texts) of rows until ``size`` code points are held."""
    ids, texts, held = [], [], 0
    for batch in columns_of(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            ids.append(doc_id)
            texts.append(text)
            held += len(text)
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def encoded(docs: DataFrame, tokenizer_path: str, work, schema: str) -> DataFrame:
    """``work(doc_id, ids as text, decoded text, count)`` gives a row of ``schema`` for each row of ``docs(doc_id, text)``.

    The tokenizer's file is read on the driver and sent along, so executors need no copy of it."""
    bound_batches(docs.sparkSession)
    content = Path(tokenizer_path).read_text(encoding="utf-8")
    key = ("word_bpe", hashlib.sha256(content.encode()).hexdigest())
    sent = docs.sparkSession.sparkContext.broadcast(content)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        encoder = Encoder(worker_cache(key, lambda: Vocabulary(json.loads(sent.value))))
        for ids, texts in chunks(batches):
            rows = [work(doc_id, *row) for doc_id, row in zip(ids, encode_texts(texts, encoder))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) if i == 0 else pa.array(c) for i, c in enumerate(zip(*rows))], names=names)

    return id_and_text(docs).mapInArrow(run, schema)


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, ids, decoded) of each row; null and empty texts have no ids and decode to the empty text.
    Ids may be null or repeated; other columns are not read."""
    return encoded(
        docs, tokenizer_path,
        lambda doc_id, ids, decoded, count: (doc_id, [int(i) for i in ids.split()], decoded),
        "doc_id bigint, ids array<bigint>, decoded string",
    )


def encode_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row, by the same encoder."""
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return encoded(
        docs, tokenizer_path,
        lambda doc_id, ids, decoded, count: (doc_id, count, sha(ids), sha(decoded)),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )
