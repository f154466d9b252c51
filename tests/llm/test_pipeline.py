"""The pipeline's stages, each on what the one before kept, against brute force."""

import re

from pyspark.sql import functions as F

import corpus_pipeline as cp
from rankloom import cluster
from rankloom.llm import bpe, queries
from test_neardup import brute as near_groups
from test_pii import strict


def test_stages(spark, sf, documents):
    docs, kept = documents, {}
    columns = documents.columns
    for name, stage in cp.STAGES[:-1]:
        docs = cluster.materialise(stage(spark, docs, sf))
        assert docs.columns == columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    lexicon = re.compile(r"\b(?:idiot|moron|loser|scum|trash|clown|stupid|pathetic|worthless|disgusting)\b", re.I)

    toxic = set(texts) - set(kept["toxicity"])
    assert toxic and all(lexicon.search(texts[i]) for i in toxic)
    assert sum(len(lexicon.findall(texts[i])) >= 3 for i in kept["toxicity"]) == 0
    groups = near_groups([(i, texts[i]) for i in kept["toxicity"]])
    assert set(kept["near_duplicates"]) == {i for i, (_, low) in groups.items() if i == low}

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))

    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        ws = words(r.text)
        size = min(10, len(ws))
        windows |= {tuple(ws[k:k + size]) for k in range(len(ws) - size + 1)}
    sizes = {len(w) for w in windows}
    clean = {i for i in kept["near_duplicates"] if not any(
        tuple(words(texts[i])[k:k + n]) in windows for n in sizes for k in range(len(words(texts[i])) - n + 1))}
    assert set(kept["decontamination"]) == clean
    assert set(kept["personal_data"]) == clean
    for i in clean:
        masked = kept["personal_data"][i]
        assert not strict(masked.text) and masked.n_chars == len(masked.text)
        assert strict(texts[i]) or masked.text == texts[i]

    rows = {r.doc_id: r for r in cp.encode_text(spark, docs, sf).collect()}
    encoder = bpe.Encoder(bpe.read_vocabulary(queries.vocabulary_path()))
    assert {i: r.token_ids for i, r in rows.items()} == {
        i: encoder.encode(kept["personal_data"][i].text) for i in clean}
    whole = queries.pipeline(spark, sf)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(clean)


def test_rows_without_text_or_id_pass(spark, sf):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "some words only", "en", "s", 15), (2, "", "en", "s", 0),
                                  (3, "mail a@b.org now", "en", "s", 16)], schema)
    for _, stage in cp.STAGES:
        docs = cluster.materialise(stage(spark, docs, sf))
    assert {r.doc_id: r.n_tokens for r in docs.collect()}.keys() == {1, 2, 3, None}


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_an_empty_table_passes_every_stage(spark, sf):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in cp.STAGES:
        done = cluster.materialise(stage(spark, docs, sf))
        assert done.count() == 0 and (name == "bpe" or done.columns == docs.columns)


def test_columns_named_like_results_keep_their_values(spark, sf):
    """Extra columns with the names of what the operators return, ties and repeated rows."""
    names = ["score", "predicted", "terms", "kept", "component_id", "n_hit", "items", "spans", "base", "row", "label", "votes"]
    texts = ["some words of a text that is like no other one", "some words of a text that is like no other one",
             "mail to a@b.org or call", "mail to a@b.org or call", None, None, "", "x " * 30_000]
    rows = [(i // 2, t, "en", "s", 0, *(f"{n}{i}" for n in names)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", {n} string" for n in names))
    given = {(r.doc_id, r.text): 0 for r in docs.collect()}
    for _, stage in cp.STAGES[:-1]:
        docs = cluster.materialise(stage(spark, docs, sf))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
        for r in docs.collect():
            assert len({r[n].removeprefix(n) for n in names}) == 1  # all of the same row
    left = docs.collect()
    # rows that repeat an id and a text stay together; the null and the empty text stay
    assert sorted(r.doc_id for r in left) == [0, 0, 1, 1, 2, 2, 3, 3] and len(given) == 5
    assert {r.text for r in left if r.doc_id == 1} == {"mail to <EMAIL> or call"}
    assert {r.n_chars for r in left if r.doc_id == 1} == {23} and {r.n_chars for r in left if r.doc_id == 0} == {0}
