"""What a Python worker still holds after a step, which the next step's memory comes on top of."""

import re
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from rankloom.llm import bpe, decontaminate, neardup, queries, toxicity

TEXT = "some words of a long text " * 80


class Taken(Exception):
    pass


def resident():
    """MB of this process without mapped files."""
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


@pytest.mark.parametrize("step", [
    lambda spark, docs: toxicity.score(docs, toxicity.Model()),
    lambda spark, docs: neardup.link_documents(docs),
    lambda spark, docs: decontaminate.find_contamination(docs, spark.createDataFrame([(1, "a b")], "item_id bigint, text string")),
    lambda spark, docs: bpe.encode_documents(docs, queries.vocabulary_path())])
def test_what_the_pool_held_is_given_back(spark, monkeypatch, step):
    """A step's function, run here on large batches as a worker runs it."""
    docs, taken = spark.createDataFrame([], "doc_id bigint, text string"), []

    def take(self, run, schema):
        taken.append(run)
        raise Taken

    monkeypatch.setattr(type(docs), "mapInArrow", take)
    with pytest.raises(Taken):
        step(spark, docs)

    def batches(rows):
        for size in rows:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int64()), pa.array([TEXT] * size, pa.string())], names=["doc_id", "text"])

    def drive(*rows):
        for _ in taken[0](batches(rows)):
            pass

    drive(1000)
    pa.default_memory_pool().release_unused()
    before = resident()
    drive(8000, 12_000, 16_000)
    assert resident() - before < 24


def test_a_text_goes_to_the_workers_once(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    packed = cp._packed(docs)
    assert "text" not in packed.schema["row"].dataType.names
    back = cp._unpacked(packed, docs, n_chars=F.lit(2).cast("bigint"))
    assert back.columns == docs.columns and [tuple(r) for r in back.collect()] == [(1, "a", "en", "s", 2)]
