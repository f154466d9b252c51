"""Every operator of the package as a query over the given tables.

Corpus: ``documents``. Queries: ``benchmark``. Two judgement sets: *verbatim*, the
documents that hold a query's text word for word (a few per query, for evaluation),
and *labelled*, the documents of quality 1 in ``labels`` that hold a query's rarest
word (for tuning, feedback and significance). Training queries are the lower half of the
range of query ids, test queries the upper half. All run over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import rankloom as rl
from rankloom import cluster
from rankloom.functions.numbers import places
from rankloom.functions.text import tokens
from rankloom.operators import metrics as metric_ops
from rankloom.operators import search as search_ops
from rankloom.operators import terms as term_ops
from rankloom.plans import compare as compare_plan

CUT = 10
JM, DIR, TFIDF = rl.Model("jm", 0.5), rl.Model("dir", 2500.0), rl.Model("tfidf")
MODELS = {"jm": JM, "dir": DIR, "tfidf": TFIDF}
SELECTED = "5-24"
ALPHA = 0.05

_stored: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make):
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.col("text").alias("contents"))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        F.col("item_id").cast("int").alias("query_id"), "text")


def index(spark: SparkSession, sf_dir: str) -> rl.Index:
    """The index of ``documents``, written once per session like any index."""
    return _once(spark, sf_dir, "index", lambda: rl.build_index(documents(spark, sf_dir)))


def judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "judgements",
                 lambda: cluster.materialise(verbatim_judgements(spark, sf_dir)))


def verbatim_judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, doc_id)`` of documents that hold a query's text word for word.

    Such a document holds every inner word of the query (the outermost ones might be
    glued to other text), so only the documents with its rarest inner word are read. A query
    without an inner word is looked for by its first characters.
    """
    ix, queries = index(spark, sf_dir), benchmark(spark, sf_dir)
    words = queries.select("query_id", tokens("text").alias("words")).select(
        "query_id", F.explode_outer(F.slice("words", F.lit(2), F.greatest(F.size("words") - 2, F.lit(0)))).alias("text"))
    # as a query set of one-word queries, so that the match sizes its own join
    inner = words.filter(F.col("text").isNotNull()).distinct()
    stats = (ix.term_stats.groupBy("term").agg(F.sum("df").alias("df")))
    rarest = (inner.join(stats, inner["text"] == stats["term"], "left")
              .groupBy("query_id")
              .agg(F.min_by("text", F.struct(F.coalesce("df", F.lit(0)), "text")).alias("text")))
    candidates = search_ops.match(ix, rarest).select("query_id", "doc_key", "doc_id")
    # both sides are spread by document already; the texts are only streamed past
    held = ix.docs.select("doc_key", "contents").join(candidates.hint("shuffle_hash"), "doc_key")
    long = (held.join(queries, "query_id").filter(F.contains("contents", "text"))
            .select("query_id", "doc_id"))
    short = words_per_query(queries).filter("n_words < 3").select("query_id", "text")
    return long.unionByName(holding_short(ix.docs.select("doc_id", "contents"), short)) if short.head(1) else long


# So many first characters of a short query are looked up, if it has them.
ANCHOR = 3


def holding_short(docs: DataFrame, short: DataFrame) -> DataFrame:
    """``(query_id, doc_id)`` of the documents that hold a query's text, by its first characters.

    A document's different stretches of as many characters are joined with them, so it meets only
    the queries that it may hold.
    """
    asked = short.withColumn("size", F.least(F.char_length("text"), F.lit(ANCHOR))).withColumn(
        "anchor", F.substring("text", F.lit(1), F.col("size")))
    size = asked.agg(F.sum(2 * F.octet_length("text") + cluster.ROW_BYTES)).first()[0]
    sizes = [r["size"] for r in asked.select("size").distinct().collect()]  # at most ANCHOR + 1
    # every stretch, also overlapping ones; the empty one is in every text
    found = F.array_distinct(F.concat(*(
        F.regexp_extract_all("contents", F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1)) if n else F.array(F.lit("")) for n in sizes)))
    met = docs.filter("contents IS NOT NULL").select("doc_id", "contents", F.explode(found).alias("anchor")).join(
        F.broadcast(asked) if size <= cluster.BROADCAST_BYTES else asked, "anchor")
    return met.filter(F.contains("contents", "text")).select("query_id", "doc_id")


def words_per_query(queries: DataFrame) -> DataFrame:
    return queries.withColumn("n_words", F.size(tokens("text")))


def rarest_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(query_id, text)``: the word of each query that the fewest documents hold."""
    words = term_ops.query_terms(benchmark(spark, sf_dir))
    stats = index(spark, sf_dir).term_stats.groupBy("term").agg(F.sum("df").alias("df"))
    return words.join(stats, "term").groupBy("query_id").agg(
        F.min_by("term", F.struct("df", "term")).alias("text"))


def halves(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The lower and the upper half of the range of query ids."""
    low, high = benchmark(spark, sf_dir).agg(F.min("query_id"), F.max("query_id")).first()
    middle = (low + high) // 2
    return f"{low}-{middle}", f"{middle + 1}-{high}"


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "labelled",
                 lambda: cluster.materialise(labelled_judgements(spark, sf_dir)))


def labelled_judgements(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    return (search_ops.match(index(spark, sf_dir), rarest_words(spark, sf_dir)).select("query_id", "doc_id")
            .join(good, "doc_id").select("query_id", "doc_id").distinct())


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback rounds: the query, then its first and its second half of words."""
    words = benchmark(spark, sf_dir).select("query_id", "text", tokens("text").alias("words"))
    half = F.floor(F.size("words") / 2).cast("int")
    texts = F.array(
        F.struct(F.lit(1).alias("round"), F.col("text").alias("text")),
        F.struct(F.lit(2).alias("round"),
                 F.concat_ws(" ", F.slice("words", F.lit(1), half)).alias("text")),
        F.struct(F.lit(3).alias("round"),
                 F.concat_ws(" ", F.slice("words", half + 1, F.size("words"))).alias("text")))
    return words.select("query_id", F.inline(texts))


def ranking(spark: SparkSession, sf_dir: str, model: rl.Model) -> DataFrame:
    return rl.search(index(spark, sf_dir), benchmark(spark, sf_dir), model, CUT)


# --- text and statistics (P1, P2, P3, A1-A4) ---

def tokens_per_doc(spark, sf_dir):
    words = documents(spark, sf_dir).select("doc_id", tokens("contents").alias("words"))
    return words.select("doc_id", F.size("words").alias("n_tokens"),
                        F.array_join("words", " ").alias("words"))


def term_frequencies(spark, sf_dir):
    return term_ops.term_frequencies(documents(spark, sf_dir)).select("doc_id", "term", "tf")


def doc_lengths(spark, sf_dir):
    return term_ops.doc_lengths(documents(spark, sf_dir))


def term_stats(spark, sf_dir):
    return term_ops.term_stats(term_ops.term_frequencies(documents(spark, sf_dir)))


def collection_stats(spark, sf_dir):
    return term_ops.collection_stats(term_ops.doc_lengths(documents(spark, sf_dir)))


def query_terms(spark, sf_dir):
    return term_ops.query_terms(benchmark(spark, sf_dir))


def select_queries(spark, sf_dir):
    return term_ops.select_queries(benchmark(spark, sf_dir), SELECTED)


# --- index, match and rank (S4, S5, J1, M1-M3, A5, T1) ---

def stored_postings(spark, sf_dir):
    return index(spark, sf_dir).postings.select("term", "doc_id", "tf", "doc_len")


def appended_ranking(spark, sf_dir):
    """The same documents appended again: all statistics double, every document ranks twice."""
    def twice():
        docs, path = documents(spark, sf_dir), cluster.fresh_folder(spark)
        rl.write_index(docs, path, "create")
        return rl.write_index(docs, path, "append")

    ix = _once(spark, sf_dir, "appended", twice)
    return rl.search(ix, benchmark(spark, sf_dir), JM, CUT).select(
        "query_id", "rank", "batch_id", "doc_id", "score")


def match(spark, sf_dir):
    """Per query word: the documents that hold it and its occurrences in them."""
    return search_ops.match(index(spark, sf_dir), benchmark(spark, sf_dir)).groupBy(
        "query_id", "term", "qtf", "df", "ctf").agg(
        F.count("*").alias("n_matches"), F.sum("tf").alias("sum_tf"), F.sum("doc_len").alias("sum_doc_len"))


def _ranked(model):
    def query(spark, sf_dir):
        return ranking(spark, sf_dir, model).select("query_id", "rank", "doc_id", "score")
    return query


def relevance_flags(spark, sf_dir):
    return search_ops.flag_relevant(ranking(spark, sf_dir, DIR), judgements(spark, sf_dir)).select(
        "query_id", "rank", "doc_id", "relevant")


def ranking_listing(spark, sf_dir):
    return rl.show_ranking(index(spark, sf_dir), ranking(spark, sf_dir, DIR),
                           judgements(spark, sf_dir), CUT)


def first_relevant(spark, sf_dir):
    queries = benchmark(spark, sf_dir)
    flagged = search_ops.flag_relevant(ranking(spark, sf_dir, JM), judgements(spark, sf_dir))
    return rl.first_relevant(queries, flagged).select(
        "query_id", "first_rank", "first_doc_id", "first_score")


# --- evaluation (E1-E5, A6) ---

def _evaluated(model, metric, on_empty="skip"):
    def query(spark, sf_dir):
        values = rl.evaluate(index(spark, sf_dir), benchmark(spark, sf_dir),
                             judgements(spark, sf_dir), model, CUT, metric, on_empty)
        return values.select("query_id", places(F.col("value")).alias("value"))
    return query


def eval_mean(spark, sf_dir):
    table = rl.evaluate_ranking(ranking(spark, sf_dir, TFIDF), benchmark(spark, sf_dir),
                                judgements(spark, sf_dir), CUT)
    means = [places(F.avg(c)).alias(f"mean_{c}") for c in metric_ops.METRICS.values()]
    return table.agg(F.count("*").alias("n_queries"), *means)


# --- tuning (X1-X5, T3) ---

def _swept(kind, metric):
    def query(spark, sf_dir):
        values = rl.sweep(index(spark, sf_dir), benchmark(spark, sf_dir),
                          labelled(spark, sf_dir), kind, CUT, metric)
        return values.select("param", "query_id", places(F.col("value")).alias("value"))
    return query


def best_param(spark, sf_dir):
    swept = rl.sweep(index(spark, sf_dir), rl.select_queries(benchmark(spark, sf_dir), halves(spark, sf_dir)[0]),
                     labelled(spark, sf_dir), "dir", CUT, "R")
    return rl.best_param(swept).select("param", places(F.col("mean")).alias("mean"))


def _train_test(spark, sf_dir):
    return rl.train_test(index(spark, sf_dir), benchmark(spark, sf_dir),
                         labelled(spark, sf_dir), "jm", CUT, "R", *halves(spark, sf_dir))


def train_test(spark, sf_dir):
    outcome = _train_test(spark, sf_dir)
    return outcome.results.select(F.lit(outcome.best).alias("best_param"), "query_id",
                                  places(F.col("value")).alias("value"))


def test_report(spark, sf_dir):
    return rl.test_report(_train_test(spark, sf_dir)).select(
        "best_param", "query", places(F.col("value")).alias("value"))


def sweep_table(spark, sf_dir):
    swept = rl.sweep(index(spark, sf_dir), benchmark(spark, sf_dir), labelled(spark, sf_dir),
                     "jm", CUT, "R")
    table = rl.sweep_table(swept, "jm")
    return table.select("query", *(places(F.col(c)).alias(c) for c in table.columns[1:]))


# --- feedback (F1, F2, J4) ---

def _feedback(residual):
    def query(spark, sf_dir):
        table = rl.feedback(index(spark, sf_dir), rounds(spark, sf_dir), labelled(spark, sf_dir),
                            DIR, CUT, "MAP", residual, on_empty="skip")
        return table.select("query_id", "round", "n_relevant",
                            places(F.col("value")).alias("value"), "first_rank", "first_doc_id",
                            "first_score")
    return query


def feedback_contents(spark, sf_dir):
    ix = index(spark, sf_dir)
    table = rl.feedback(ix, rounds(spark, sf_dir), labelled(spark, sf_dir), TFIDF, CUT, "P",
                        True, on_empty="skip")
    return rl.with_contents(ix, table).select(
        "query_id", "round", places(F.col("value")).alias("value"), "first_contents")


# --- significance (J5, Q1-Q3) ---

def _runs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Precision of each sweep value of Jelinek-Mercer (b) against the value 0.5 (a), as pairs of runs."""
    swept = _once(spark, sf_dir, "swept", lambda: cluster.materialise(rl.sweep(
        index(spark, sf_dir), benchmark(spark, sf_dir), labelled(spark, sf_dir),
        "jm", CUT, "P")))
    others = swept.filter(F.col("param") != 0.5).select(
        F.col("param").alias("pair_id"), "query_id", "value")
    base = swept.filter(F.col("param") == 0.5).select("query_id", "value")
    return others.select("pair_id", "query_id").join(base, "query_id"), others


def paired_t(spark, sf_dir):
    a, b = _runs(spark, sf_dir)
    table = compare_plan.paired_t(compare_plan.paired(a, b, ["pair_id"]), ["pair_id"])
    return table.select("pair_id", "n", places(F.col("statistic")).alias("statistic"),
                        places(F.col("p_value")).alias("p_value"))


def wilcoxon(spark, sf_dir):
    a, b = _runs(spark, sf_dir)
    table = compare_plan.wilcoxon(compare_plan.paired(a, b, ["pair_id"]), ["pair_id"])
    return table.select("pair_id", "n", "statistic", places(F.col("p_value")).alias("p_value"))


def significance_decision(spark, sf_dir):
    a, b = _runs(spark, sf_dir)
    both = [rl.compare(a, b, test, ALPHA, ["pair_id"]).select(
        "pair_id", F.lit(test).alias("test"), "significant") for test in ("t", "wilcoxon")]
    return both[0].unionByName(both[1])


# --- text sources and sinks (S1-S3, S6, S7) ---

def corpus_source(spark, sf_dir):
    path = cluster.fresh_folder(spark)
    records = documents(spark, sf_dir).select(
        F.concat_ws("\n", F.col("doc_id").cast("string"), "contents"))
    records.write.option("lineSep", "\n   /\n").text(path)
    return rl.read_corpus(spark, path)


def corpus_source_crlf(spark, sf_dir):
    """The same collection with the other line ending."""
    path = cluster.fresh_folder(spark)
    records = documents(spark, sf_dir).select(
        F.replace(F.concat_ws("\n", F.col("doc_id").cast("string"), "contents"), F.lit("\n"), F.lit("\r\n")))
    records.write.option("lineSep", "\r\n   /\r\n").text(path)
    return rl.read_corpus(spark, path)


def eval_error_policy(spark, sf_dir):
    """Queries without a judgement would be an error: those with one are evaluated so."""
    qrels = judgements(spark, sf_dir)
    judged = benchmark(spark, sf_dir).join(qrels.select("query_id").distinct(), "query_id", "left_semi")
    values = rl.evaluate(index(spark, sf_dir), judged, qrels, DIR, CUT, "P", "error")
    return values.select("query_id", places(F.col("value")).alias("value"))


def query_source(spark, sf_dir):
    path = cluster.fresh_folder(spark)
    records = benchmark(spark, sf_dir).select(
        F.concat_ws("\n", F.col("query_id").cast("string"), "text"))
    records.write.option("lineSep", "\n/\n").text(path)
    return rl.read_queries(spark, path)


def judgement_source(spark, sf_dir):
    path = cluster.fresh_folder(spark)
    lists = judgements(spark, sf_dir).groupBy("query_id").agg(
        F.array_join(F.collect_list(F.col("doc_id").cast("string")), " ").alias("ids"))
    records = lists.select(F.concat_ws("\n", F.col("query_id").cast("string"), "ids"))
    records.write.option("lineSep", "\n   /\n").text(path)
    return rl.read_qrels(spark, path)


def results_source(spark, sf_dir):
    path = cluster.fresh_folder(spark)
    rl.write_results(_evaluated(JM, "R")(spark, sf_dir), path)
    return rl.read_results(spark, path)


def queries() -> dict:
    plain = [tokens_per_doc, term_frequencies, doc_lengths, term_stats, collection_stats,
             query_terms, select_queries, stored_postings, appended_ranking, match,
             relevance_flags, ranking_listing, first_relevant, eval_mean, best_param, train_test,
             test_report, sweep_table, feedback_contents, paired_t, wilcoxon,
             significance_decision, corpus_source, corpus_source_crlf, eval_error_policy, query_source, judgement_source, results_source]
    table = {f.__name__: f for f in plain}
    table["judgements"] = verbatim_judgements
    table["judgements_labelled"] = labelled_judgements
    table.update({f"rank_{name}": _ranked(model) for name, model in MODELS.items()})
    table["eval_precision"] = _evaluated(DIR, "P")
    table["eval_recall"] = _evaluated(DIR, "R")
    table["eval_ap"] = _evaluated(DIR, "MAP")
    table["eval_include_empty"] = _evaluated(JM, "R", "include")
    table["sweep_jm"] = _swept("jm", "P")
    table["sweep_dir"] = _swept("dir", "R")
    table["feedback_rounds"] = _feedback(False)
    table["feedback_residual"] = _feedback(True)
    return table
