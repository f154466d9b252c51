"""Byte-pair encoding and decoding with a given vocabulary of words with ends.

A word is a doubly linked list of symbols. A priority queue holds the merges that its
neighbours allow, by rank and then by place; an entry whose symbols have been merged
meanwhile is stale and skipped. Decoding joins the vocabulary strings of the ids.

Rows: a null text counts as empty and has no tokens; texts are taken whole; repeated rows
are encoded alike; a column of the input called ``token_ids`` or ``decoded`` is replaced,
every other one is kept.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from rankloom.llm.common import column_text, released, with_columns

# Words that a generation of a Python worker's memory holds; a longer word counts once more for every so many
# characters. When a generation is full it becomes the older one, and the older one is forgotten.
REMEMBERED = 150_000
WEIGHED = 32
# A vocabulary is sent to every executor; a larger file is refused.
VOCABULARY_BYTES = 64 << 20
# Text per step: ids and decoded strings of a slice are in memory together.
STEP_BYTES = 2 << 20

# The splitting pattern and the white space of the vocabulary's file format.
SPACE = r"\t-\r \x85\xa0  -     　"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
# Letters and numbers that Python's own character tables do not know yet. For words with one of them the
# tables of the tokenizers library decide what is a letter and what its lower case is.
NEWER = frozenset(
    c for c in regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)])))
    if unicodedata.category(c) == "Cn")
# Control characters that str.split() takes for white space and the pattern does not.
SEPARATORS = re.compile(r"[\x1c-\x1f]")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """What a tokenizer file says; built on the driver, sent to the workers."""

    encoder: Encoder | None = None  # of this worker

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if (model["type"], model.get("end_of_word_suffix")) != ("BPE", "</w>") or \
                kinds != ["NFC", "Replace", "Lowercase"] or spec.get("decoder"):
            raise ValueError("a BPE file with lower case and word ends is needed")
        ids = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.strings = {i: s for s, i in (ids | self.special).items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        alphabet = byte_alphabet()
        self.inner = [ids.get(c) for c in alphabet]
        self.last = [ids.get(c + "</w>") for c in alphabet]
        self.whole = None not in self.inner and None not in self.last


def merged(symbols: list[int], merges: dict) -> list[int]:
    """The symbols of one word after all merges."""
    n = len(symbols)
    if n < 2:
        return symbols
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    queue = []
    for i in range(n - 1):
        found = merges.get((symbols[i], symbols[i + 1]))
        if found:
            queue.append((found[0], i, symbols[i], symbols[i + 1], found[1]))
    heapq.heapify(queue)
    while queue:
        _, i, left, right, new = heapq.heappop(queue)
        j = after[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # stale
        symbols[i], symbols[j] = new, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = merges.get((new, symbols[k]))
            if found:
                heapq.heappush(queue, (found[0], i, new, symbols[k], found[1]))
        h = before[i]
        if h >= 0:
            found = merges.get((symbols[h], new))
            if found:
                heapq.heappush(queue, (found[0], h, symbols[h], new, found[1]))
    return [s for s in symbols if s >= 0]


class Encoder:
    """Encodes whole texts; remembers a bounded number of words, and of stretches made of several words.

    A word by itself is split as it was within its stretch, so that both are remembered alike.
    """

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.v, self.remembered = vocabulary, remembered
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.held = 0
        self.split = regex.compile(SPLIT)
        self.spaces = re.compile(f"[{SPACE}]+")
        self.special = (re.compile("|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))))
                        if vocabulary.special else None)

    def word(self, word: str) -> tuple[int, ...]:
        """The ids of one word, merged anew."""
        data = word.encode("utf-8", "surrogatepass")
        inner = self.v.inner
        symbols = [inner[b] for b in data[:-1]]
        symbols.append(self.v.last[data[-1]])
        return tuple(merged(symbols if self.v.whole else [s for s in symbols if s is not None], self.v.merges))

    def keep(self, chunk: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        weight = 1 + len(chunk) // WEIGHED
        self.held += weight
        if self.held > self.remembered:
            self.older = self.known.copy()
            self.known.clear()
            self.held = weight
        self.known[chunk] = ids
        return ids

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """The ids of a stretch without white space."""
        if ids := self.older.get(chunk):
            return self.keep(chunk, ids)
        if not chunk.isascii() and not NEWER.isdisjoint(chunk):
            lowered = normalizers.Lowercase().normalize_str(chunk)
            words = [w for w, _ in pre_tokenizers.Split(Regex(SPLIT), "removed", invert=True).pre_tokenize_str(lowered)]
            return self.keep(chunk, tuple(chain.from_iterable(map(self.word, words))))
        words = self.split.findall(chunk)
        if len(words) == 1:
            return self.keep(chunk, self.word(words[0]))
        return self.keep(chunk, tuple(chain.from_iterable(
            [self.known.get(w) or self.older.get(w) or self.keep(w, self.word(w)) for w in words])))

    def plain(self, text: str) -> list[tuple[int, ...]]:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # white space always splits, so that the stretches between can be remembered
        parts = self.spaces.split(text) if SEPARATORS.search(text) else text.split()
        known = self.known.get
        return [known(p) or self.chunk(p) for p in parts if p]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.special is None or not self.special.search(text):
            return list(chain.from_iterable(self.plain(text)))
        ids, at = [], 0
        for found in self.special.finditer(text):
            ids += chain.from_iterable(self.plain(text[at:found.start()]))
            ids.append(self.v.special[found.group()])
            at = found.end()
        ids += chain.from_iterable(self.plain(text[at:]))
        return ids


def decode(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The vocabulary strings of the ids, with a blank between them."""
    return " ".join(map(vocabulary.strings.__getitem__, ids))


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = file.read(VOCABULARY_BYTES + 1)
    if len(content) > VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary is larger than {VOCABULARY_BYTES} characters")
    return Vocabulary(content)


def _shared(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(read_vocabulary(path))


def encode_documents(docs: DataFrame, vocabulary: str, text: str = "text",
                     decoded: bool = False) -> DataFrame:
    """``docs`` with ``token_ids``, and with ``decoded``, the text that these give back.

    ``vocabulary`` is the tokenizer file's path on the driver. No row is moved; a word
    is merged once per worker while it is remembered.
    """
    shared = _shared(docs.sparkSession, vocabulary)
    fields = T.StructType([T.StructField("token_ids", T.ArrayType(T.IntegerType(), False), False)])
    if decoded:
        fields = fields.add("decoded", T.StringType(), False)

    def start():
        v = shared.value
        # the words of earlier tasks of the same worker are remembered with the vocabulary
        v.encoder = encoder = v.encoder or Encoder(v)

        def step(piece):
            rows = [encoder.encode(t) for t in column_text(piece, text)]
            arrays = [_lists(rows)]
            if decoded:
                arrays.append(pa.array([decode(v, r) for r in rows], pa.string()))
            return arrays
        return step

    return with_columns(docs, text, fields, start, STEP_BYTES)


def decode_tokens(encoded: DataFrame, vocabulary: str, ids: str = "token_ids") -> DataFrame:
    """``encoded`` with ``decoded``; a null list gives a null."""
    shared = _shared(encoded.sparkSession, vocabulary)
    kept = [c for c in encoded.columns if c != "decoded"]
    source = encoded.select(*kept)
    schema = T.StructType([*source.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        v = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                lists = piece.column(piece.schema.get_field_index(ids)).to_pylist()
                texts = pa.array([None if r is None else decode(v, r) for r in lists], pa.string())
                yield pa.RecordBatch.from_arrays([*piece.columns, texts],
                                                 names=[*piece.schema.names, "decoded"])

    return source.mapInArrow(released(run), schema)


def _lists(rows: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
