"""Each operator as a query over its whole table."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import bpe, curriculum, decontaminate, langid, lm, neardup, periodic, phrases, pii, sharding, suffixes, toxicity, winnow
from rankloom.llm.common import fold_of

SHARDS = 24


def vocabulary_path() -> str:
    """Where the installed package of public vocabularies keeps the file."""
    return str(public_tokenizers.path("word_bpe_49k.json"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hex_digest(text):
    return F.sha2(text.cast("binary"), 256)


def op1_winnow(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return winnow.edited_fingerprints(docs).select(
        "doc_id", "n_chars", hex_digest(F.col("edited")).alias("edited_sha256"),
        winnow.shown(F.col("marks")).alias("fingerprint"),
        winnow.shown(F.col("edited_marks")).alias("edited_fingerprint"), "near_edited", "near_next")


def op2_neardup(spark, sf_dir):
    return neardup.link_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op3_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode_documents(docs, vocabulary_path(), decoded=True)
    ids = F.concat_ws(" ", F.col("token_ids").cast("array<string>"))
    return done.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"),
                       hex_digest(ids).alias("ids_sha256"),
                       hex_digest(F.col("decoded")).alias("decoded_sha256"))


def op4_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm.score_documents(docs, fold_of(F.col("doc_id"), 7) == 2)


def op5_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    counts = [F.size(F.filter(F.col("base.kind"), lambda kind: kind == name)).cast("bigint").alias(f"n_{name}")
              for name in pii.KINDS]
    return found.select("doc_id", *counts, hex_digest(pii.listed(F.col("base"))).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold_of(F.col("doc_id"), 5) == 0
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tree = sharding.regular_tree(SHARDS)
    return sharding.assign_shards(docs, tree, sharding.grown_tree(tree))


def op8_suffixes(spark, sf_dir):
    return suffixes.repeated_passages(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "end", "n_words")


def op9_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        decontaminate.items_digest(F.col("items")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op10_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold_of(F.col("doc_id"), 4) == 2
    profiles = langid.learn_profiles(docs.filter(~held_out))
    return langid.identify(docs.select("doc_id", "text"), profiles).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_phrases(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return phrases.mine_phrases(docs).drop("cut")


def _repeated_words(row: dict, n: int) -> np.ndarray | None:
    """op12's rewritten texts: from some word on, one in ten repeats with a period."""
    h = zlib.crc32(str("" if row["doc_id"] is None else row["doc_id"]).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return places


def op12_periodic(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.find_runs(docs, rewrite=_repeated_words, digest=True)
    lines = F.transform("runs", lambda r: F.concat(
        *(F.concat(r[c].cast("string"), F.lit(end)) for c, end in (("start", ","), ("length", ","), ("period", "\n")))))
    best = F.get(F.array_sort("runs", periodic.by_power), F.lit(0))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        hex_digest(F.array_join(lines, "")).alias("runs_sha256"),
        F.lower(F.hex("collapsed")).alias("collapsed_sha256"))


# Sources weigh 1, 2, 3 and so on: the first kind grows over the training, the third one fades.
CURRICULUM = (curriculum.ramp(1.0, 0.5), curriculum.ramp(2.0), curriculum.ramp(3.0, -0.5))


def op13_curriculum(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return curriculum.by_first_position(curriculum.mix(docs, CURRICULUM)).select(
        "doc_id", "size", "source_size", "target", "taken", F.size("passes").cast("bigint").alias("n_passes"), "position")


def pipeline(spark, sf_dir):
    import corpus_pipeline  # stands at the top of the repository and uses this module

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    import corpus_pipeline  # noqa: F401  without it there is no pipeline to register

    return {f.__name__: f for f in (
        op1_winnow, op2_neardup, op3_bpe, op4_lm, op5_pii, op6_toxicity, op7_sharding, op8_suffixes,
        op9_decontaminate, op10_langid, op11_phrases, op12_periodic, op13_curriculum, pipeline)}
