"""Encoding and decoding against the tokenizers library."""

import hashlib
import random
import sys
import time

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rankloom.llm import bpe, queries

PATH = queries.vocabulary_path()
ODD = ["", "  ", "a\x1cb !\x1c! x", "İstanbul ΣΑΣ ΟΔΟΣ", "it's <|endoftext|>x <|startoftext|>", "１２３ ½ Ⅷ ²", "é 한국어 日本語",
       "😀👍🏽 a‍b", "'such 're 'll don't I'M", "<|endoftext|", "a\u0085b c d　e​f", "x" * 3000, "ab" * 2000 + " !?!?" * 50]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation(), t.no_padding()
    return t


def test_odd_texts(library):
    encoder = bpe.Encoder(bpe.read_vocabulary(PATH), remembered=50)
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz .,'!0123ÄÖÜßéñçœ"
    for text in ODD + ["".join(rng.choices(letters, k=rng.randrange(80))) for _ in range(500)]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids
        assert bpe.decode(encoder.v, ids) == library.decode(ids, skip_special_tokens=False)


def test_every_code_point(library):
    encoder = bpe.Encoder(bpe.read_vocabulary(PATH))
    points = [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]
    for at in range(0, len(points), 2000):
        text = " ".join(f"a{chr(c)}b{chr(c)}{chr(c)}" for c in points[at:at + 2000])
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids, hex(points[at])


def test_query(spark, sf, documents, library):
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = {r.doc_id: r for r in queries.op3_bpe(spark, sf).collect()}
    for d in documents.collect():
        ids = library.encode(d.text, add_special_tokens=False).ids
        r = rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), digest(" ".join(map(str, ids))))
        assert r.decoded_sha256 == digest(library.decode(ids, skip_special_tokens=False))


def test_stale_entries_are_skipped():
    ids = {(0, 1): (0, 10), (1, 2): (1, 11), (10, 2): (2, 12), (2, 0): (3, 13)}
    assert bpe.merged([0, 1, 2, 0], ids) == [12, 0]
    assert bpe.merged([0], ids) == [0] and bpe.merged([], ids) == []


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (2, "Hi there", "z"), (2, "Hi there", None)],
                                 "doc_id bigint, text string, token_ids string")
    rows = bpe.encode_documents(docs, PATH, decoded=True).collect()
    assert [len(r.token_ids) for r in rows] == [0, 0, 2, 2] and rows[2] == rows[3] and rows[2].decoded == "hi</w> there</w>"
    again = bpe.decode_tokens(bpe.encode_documents(docs, PATH), PATH).collect()
    assert [r.decoded for r in again] == [r.decoded for r in rows]
    assert bpe.encode_documents(docs.limit(0), PATH).collect() == []


def test_a_worker_keeps_its_words(spark):
    """Tasks that share a worker's vocabulary share the words that it remembers."""
    class Kept:
        value = bpe.read_vocabulary(PATH)

    taken = []

    def with_columns(docs, text, fields, start, limit):
        taken.append(start)
        return docs

    before, shared = bpe.with_columns, bpe._shared
    bpe.with_columns, bpe._shared = with_columns, lambda *_: Kept
    try:
        bpe.encode_documents(spark.range(1), "unused")
    finally:
        bpe.with_columns, bpe._shared = before, shared
    piece = pa.RecordBatch.from_pydict({"text": ["words that stay"]})
    first = taken[0]()(piece)
    kept = Kept.value.encoder
    assert kept.known and taken[0]()(piece)[0].equals(first[0]) and Kept.value.encoder is kept


def test_a_letter_beyond_ascii_costs_no_search():
    """New words with an accent take about as long as others; the test for newer letters took five times as long."""
    v, rng = bpe.read_vocabulary(PATH), random.Random(5)
    plain = ["".join(rng.choices("abcdefghijklmnoprstuvw", k=10)) for _ in range(3000)]
    accented = [w[:-1] + "é" for w in plain]

    def seconds(words):
        encoder, began = bpe.Encoder(v), time.process_time()
        encoder.encode(" ".join(words))
        return time.process_time() - began

    assert min(seconds(accented) for _ in range(3)) < 3 * min(seconds(plain) for _ in range(3))


def test_a_word_is_merged_once_in_all_its_stretches(library, monkeypatch):
    merges, merged = [], bpe.merged
    monkeypatch.setattr(bpe, "merged", lambda symbols, known: merges.append(1) or merged(symbols, known))
    encoder, text = bpe.Encoder(bpe.read_vocabulary(PATH)), "stretches, (stretches) stretches. stretches"
    assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert len(merges) == 5  # the word and four signs


def test_memory_is_bounded_and_changes_nothing(library):
    """Words go from generation to generation; long ones weigh more."""
    encoder, rng = bpe.Encoder(bpe.read_vocabulary(PATH), remembered=20), random.Random(7)
    for _ in range(300):
        text = " ".join("".join(rng.choices("abé'.1", k=rng.choice([1, 2, 3, 400]))) for _ in range(8))
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids
        for memory in (encoder.known, encoder.older):
            assert len(memory) == 1 or sum(1 + len(w) // bpe.WEIGHED for w in memory) <= 20
