"""SQL for every registered query, written apart from the package and run by DuckDB."""

from __future__ import annotations

# Words by Unicode word rules, in a form without look-around.
WORD = r"(?:\p{L}(?:[.''’·:]\p{L})+|\p{N}(?:[.,;'']\p{N})+|[\p{L}\p{M}\p{N}_])+"
CUT = 10


def six(x: str) -> str:
    return f"floor(({x}) * 1e6 + 0.5) / 1e6"


def words(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '{WORD}')"


def length_code(n: str) -> str:
    over = f"CAST({n} - 24 AS BIGINT)"
    shift = f"(CAST(floor(log2(greatest({over}, 1))) AS INTEGER) - 3)"
    return (f"CAST(CASE WHEN {n} < 40 THEN {n} "
            f"ELSE 24 + (({over} // CAST(pow(2, {shift}) AS BIGINT)) * CAST(pow(2, {shift}) AS BIGINT)) "
            "END AS INTEGER)")


# Common table expressions, each usable once those before it are there.
CORPUS = f"""
tok AS (SELECT doc_id, {words('text')} AS ws FROM documents),
dl AS (SELECT doc_id, CAST(len(ws) AS INTEGER) AS n_tokens, {length_code('len(ws)')} AS doc_len FROM tok),
post AS (SELECT doc_id, term, CAST(count(*) AS INTEGER) AS tf
         FROM (SELECT doc_id, unnest(ws) AS term FROM tok) GROUP BY doc_id, term),
ts AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM post GROUP BY term),
cs AS (SELECT count(*) FILTER (n_tokens > 0) AS doc_count,
              CAST(sum(n_tokens) AS BIGINT) AS total_terms FROM dl)"""
ASKED = "q AS (SELECT CAST(item_id AS INTEGER) AS query_id, text FROM benchmark)"
ROUNDS = f"""
qw AS (SELECT CAST(item_id AS INTEGER) AS query_id, text, {words('text')} AS ws FROM benchmark),
q AS (SELECT query_id, 1 AS round, text FROM qw
      UNION ALL SELECT query_id, 2, array_to_string(ws[1:len(ws) // 2], ' ') FROM qw
      UNION ALL SELECT query_id, 3, array_to_string(ws[len(ws) // 2 + 1:], ' ') FROM qw)"""
QRELS = """
qrels AS (SELECT DISTINCT CAST(b.item_id AS INTEGER) AS query_id, d.doc_id
          FROM documents d JOIN benchmark b ON contains(d.text, b.text)),
nrel AS (SELECT query_id, count(*) AS n FROM qrels GROUP BY query_id)"""

LABELLED = f"""
rarest AS (SELECT query_id, arg_min(term, (df, term)) AS term FROM (
             SELECT CAST(item_id AS INTEGER) AS query_id, unnest({words('text')}) AS term FROM benchmark)
           JOIN ts USING (term) GROUP BY query_id),
qrels AS (SELECT DISTINCT query_id, doc_id FROM rarest
          JOIN post USING (term) JOIN labels USING (doc_id) WHERE quality = 1),
nrel AS (SELECT query_id, count(*) AS n FROM qrels GROUP BY query_id)"""


def matched(keys: str = "query_id") -> str:
    return f"""
qt AS (SELECT {keys}, term, CAST(count(*) AS INTEGER) AS qtf
       FROM (SELECT {keys}, unnest({words('text')}) AS term FROM q) GROUP BY {keys}, term),
m AS (SELECT {keys}, term, qtf, doc_id, tf, doc_len, df, ctf,
             (ctf + 1e0) / (total_terms + 1e0) AS p,
             1e0 + ln((doc_count + 1e0) / (df + 1e0)) AS idf
      FROM qt JOIN ts USING (term) JOIN post USING (term) JOIN dl USING (doc_id), cs)"""


def term_score(kind: str, param: str = "") -> str:
    if kind == "jm":
        return f"ln(1e0 + ((1e0 - {param}) * tf / doc_len) / ({param} * p))"
    if kind == "dir":
        return (f"CASE WHEN {param} = 0 THEN 0e0 ELSE greatest(0e0, "
                f"ln(1e0 + tf / (greatest({param}, 1e-9) * p)) + "
                f"ln(greatest({param}, 1e-9) / (doc_len + greatest({param}, 1e-9)))) END")
    return "sqrt(tf) * idf / sqrt(doc_len)"


def ranked(kind: str, param: str = "", keys: str = "query_id", source: str = "m",
           name: str = "ranking") -> str:
    return f"""
{name}_s AS (SELECT {keys}, doc_id, {six(f'sum(qtf * ({term_score(kind, param)}))')} AS score
       FROM {source} GROUP BY {keys}, doc_id),
{name} AS (SELECT * FROM (
    SELECT {keys}, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, doc_id) AS INTEGER)
             AS rank, doc_id, score FROM {name}_s) WHERE rank <= {CUT})"""


def flagged(keys: str = "query_id", source: str = "ranking", name: str = "flagged") -> str:
    return f"""
{name} AS (SELECT r.*, q2.doc_id IS NOT NULL AS relevant
            FROM {source} r LEFT JOIN qrels q2 ON r.query_id = q2.query_id AND r.doc_id = q2.doc_id)"""


def measured(keys: str = "query_id", asked: str = "q", source: str = "flagged",
             name: str = "measured") -> str:
    """All three metrics for every row of ``asked``; n is 0 where nothing is judged."""
    return f"""
{name}_r AS (SELECT *, sum(CAST(relevant AS INTEGER)) OVER (
        PARTITION BY {keys} ORDER BY rank ROWS UNBOUNDED PRECEDING) AS so_far FROM {source}),
{name}_g AS (SELECT {keys}, count(*) AS got, count(*) FILTER (relevant) AS hits,
             coalesce(sum(CAST(so_far AS DOUBLE) / rank) FILTER (relevant), 0e0) AS precisions
      FROM {name}_r GROUP BY {keys}),
{name} AS (SELECT {', '.join('a.' + k.strip() for k in keys.split(','))},
             coalesce(n.n, 0) AS n, CAST(hits AS DOUBLE) / got AS p_value,
             CASE WHEN coalesce(n.n, 0) = 0 THEN 1e0 ELSE CAST(hits AS DOUBLE) / n.n END AS r_value,
             CASE WHEN coalesce(n.n, 0) = 0 THEN 'NaN'::DOUBLE ELSE precisions / n.n END AS ap_value
      FROM {asked} a LEFT JOIN nrel n USING (query_id) LEFT JOIN {name}_g g USING ({keys}))"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


JM, DIR = ("jm", "0.5e0"), ("dir", "2500e0")
RANKED = {"jm": ranked(*JM), "dir": ranked(*DIR), "tfidf": ranked("tfidf")}


def evaluation(model: str, column: str, skip: bool = True) -> str:
    return (with_(CORPUS, ASKED, QRELS, matched(), RANKED[model], flagged(), measured())
            + f"SELECT query_id, {six(column)} AS value FROM measured"
            + (" WHERE n > 0" if skip else ""))


JM_PARAMS = ", ".join(f"({i / 10}e0)" for i in range(1, 11))
DIR_PARAMS = ", ".join(f"({i}e0)" for i in range(0, 5001, 500))


def swept(kind: str, queries: str = "") -> str:
    params = JM_PARAMS if kind == "jm" else DIR_PARAMS
    return with_(
        CORPUS, ASKED + (f",\nqs AS (SELECT * FROM q WHERE {queries})" if queries else
                         ",\nqs AS (SELECT * FROM q)"),
        LABELLED, matched(), f"params AS (SELECT * FROM (VALUES {params}) v(param))",
        "mp AS (SELECT * FROM m, params)",
        ranked(kind, "param", "param, query_id", "mp"), flagged("param, query_id"),
        "asked AS (SELECT param, query_id FROM qs, params)",
        measured("param, query_id", "asked"))


MIDDLE = "(SELECT (min(query_id) + max(query_id)) // 2 FROM q)"


def trained() -> str:
    """Best Jelinek-Mercer parameter by mean recall on the lower half, and its values on the upper."""
    return swept("jm") + f""", means AS (
    SELECT param, {six('avg(r_value)')} AS mean FROM measured WHERE query_id <= {MIDDLE} GROUP BY param),
best AS (SELECT param FROM means WHERE mean > 0 ORDER BY mean DESC, param LIMIT 1),
tested AS (SELECT param AS best_param, query_id, r_value FROM measured JOIN best USING (param)
           WHERE query_id > {MIDDLE})
"""


SWEEP_COLUMNS = [(f"{i / 10}e0", f"lambda_{i / 10:g}".replace(".", "_")) for i in range(1, 11)]
SWEEP_TABLE = swept("jm") + ", cells AS (SELECT query_id, " + ", ".join(
    f"max(r_value) FILTER (param = {p}) AS {c}" for p, c in SWEEP_COLUMNS) + """
  FROM measured GROUP BY query_id)
SELECT CAST(query_id AS VARCHAR) AS query, """ + ", ".join(
    f"{six(c)} AS {c}" for _, c in SWEEP_COLUMNS) + """ FROM cells
UNION ALL SELECT 'mean', """ + ", ".join(six(f"avg({c})") for _, c in SWEEP_COLUMNS) + " FROM cells"


def feedback(model: str, residual: bool) -> str:
    """Three rounds per query, each taking one more document from the judged set if residual."""
    keys = "query_id, round"
    parts = [CORPUS, ROUNDS, LABELLED, matched(keys),
             ranked(*DIR, keys=keys) if model == "dir" else ranked("tfidf", keys=keys),
             flagged(keys)]
    if residual:
        parts.append("""
t1 AS (SELECT query_id, 1 AS taken_round, arg_min(doc_id, rank) AS doc_id FROM flagged
       WHERE relevant AND round = 1 GROUP BY query_id),
t2 AS (SELECT query_id, 2 AS taken_round, arg_min(doc_id, rank) AS doc_id FROM flagged f
       WHERE relevant AND round = 2 AND (query_id, doc_id) NOT IN (SELECT query_id, doc_id FROM t1)
       GROUP BY query_id),
taken AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2),
live AS (SELECT f.query_id, f.round, f.rank, f.doc_id, f.score,
                f.relevant AND NOT EXISTS (SELECT 1 FROM taken t WHERE t.query_id = f.query_id
                    AND t.doc_id = f.doc_id AND t.taken_round < f.round) AS relevant FROM flagged f),
left_over AS (SELECT q.query_id, q.round, n.n - (SELECT count(*) FROM taken t
                    WHERE t.query_id = q.query_id AND t.taken_round < q.round) AS n
              FROM q JOIN nrel n USING (query_id))""")
    else:
        parts.append("""
live AS (SELECT * FROM flagged),
left_over AS (SELECT q.query_id, q.round, n.n FROM q JOIN nrel n USING (query_id))""")
    parts.append("""
run AS (SELECT *, sum(CAST(relevant AS INTEGER)) OVER (
        PARTITION BY query_id, round ORDER BY rank ROWS UNBOUNDED PRECEDING) AS so_far FROM live),
per AS (SELECT query_id, round, count(*) AS got, count(*) FILTER (relevant) AS hits,
               coalesce(sum(CAST(so_far AS DOUBLE) / rank) FILTER (relevant), 0e0) AS precisions,
               min(rank) FILTER (relevant) AS first_rank,
               arg_min(doc_id, rank) FILTER (relevant) AS first_doc_id,
               arg_min(score, rank) FILTER (relevant) AS first_score
        FROM run GROUP BY query_id, round),
fb AS (SELECT l.query_id, l.round, CAST(l.n AS BIGINT) AS n_relevant, got, hits, precisions,
              first_rank, first_doc_id, first_score
       FROM left_over l LEFT JOIN per USING (query_id, round) WHERE l.n > 0)""")
    return with_(*parts)


# Pairs of runs: precision under each Jelinek-Mercer value against the one under 0.5.
PAIRS = swept("jm") + """, pairs AS (
    SELECT b.param AS pair_id, b.query_id, a.p_value AS a, b.p_value AS b
    FROM measured b JOIN measured a ON a.query_id = b.query_id AND a.param = 0.5e0
    WHERE b.param <> 0.5e0),
"""
# Student's t: coefficients of the finite series by the gamma function.
T_TEST = PAIRS + """
sums AS (SELECT pair_id, count(*) AS n, avg(a - b) AS mean, var_samp(a - b) AS variance,
                max(a - b) > min(a - b) AS varies FROM pairs GROUP BY pair_id),
t AS (SELECT pair_id, n, CASE WHEN varies THEN mean / sqrt(variance / n)
             WHEN mean = 0 THEN NULL ELSE sign(mean) * 'Infinity'::DOUBLE END AS t, n - 1 AS nu FROM sums),
th AS (SELECT *, atan(abs(t) / sqrt(nu)) AS theta FROM t),
inside AS (SELECT *, CASE
    WHEN nu = 1 THEN 2 / pi() * theta
    WHEN nu % 2 = 1 THEN 2 / pi() * (theta + sin(theta) * list_sum(list_transform(
        range(0, (nu - 1) // 2), lambda k: cos(theta) * pow(cos(theta), 2 * k) * sqrt(pi()) / 2
            * exp(lgamma(k + 1) - lgamma(k + 1.5e0)))))
    ELSE sin(theta) * list_sum(list_transform(
        range(0, nu // 2), lambda k: pow(cos(theta), 2 * k) / sqrt(pi())
            * exp(lgamma(k + 0.5e0) - lgamma(k + 1)))) END AS inner_part FROM th),
t_out AS (SELECT pair_id, n, t AS statistic,
                 CASE WHEN t IS NULL THEN NULL WHEN isinf(t) THEN 0e0 ELSE greatest(0e0, 1 - inner_part) END AS p FROM inside)
"""
# Wilcoxon: mean ranks by window functions, the normal distribution by its power series.
WILCOXON_CTES = """
d AS (SELECT pair_id, floor((b - a) * 1e9 + 0.5) AS d FROM pairs),
rk AS (SELECT pair_id, d, rank() OVER (PARTITION BY pair_id ORDER BY abs(d))
              + (count(*) OVER (PARTITION BY pair_id, abs(d)) - 1) / 2e0 AS r FROM d),
w AS (SELECT pair_id, CAST(count(*) AS BIGINT) AS n, coalesce(sum(r) FILTER (d > 0), 0e0) AS up
      FROM rk GROUP BY pair_id),
z AS (SELECT pair_id, n, least(up, n * (n + 1) / 2e0 - up) AS statistic,
             abs((least(up, n * (n + 1) / 2e0 - up) - n * (n + 1) / 4e0 - 0.5e0)
                 / sqrt(n * (n + 1) * (2 * n + 1) / 24e0)) AS x FROM w),
w_out AS (SELECT pair_id, n, statistic, greatest(0e0, 1e0 - 2 / sqrt(2 * pi()) * list_sum(list_transform(
        range(0, 120), lambda k: exp(-x * x / 2 + (2 * k + 1) * ln(x) + k * ln(2e0)
            + lgamma(k + 1) - lgamma(2 * k + 2))))) AS p FROM z)
"""


def oracle_sql() -> dict[str, str]:
    rank_cols = "SELECT query_id, rank, doc_id, score FROM ranking"
    sql = {
        "tokens_per_doc": with_(CORPUS) + """
            SELECT doc_id, CAST(len(ws) AS INTEGER) AS n_tokens, array_to_string(ws, ' ') AS words FROM tok""",
        "term_frequencies": with_(CORPUS) + "SELECT doc_id, term, tf FROM post",
        "doc_lengths": with_(CORPUS) + "SELECT doc_id, n_tokens, doc_len FROM dl",
        "term_stats": with_(CORPUS) + "SELECT term, df, ctf FROM ts",
        "collection_stats": with_(CORPUS) + "SELECT doc_count, total_terms FROM cs",
        "query_terms": with_(CORPUS, ASKED, matched()) + "SELECT query_id, term, qtf FROM qt",
        "select_queries": with_(ASKED) + "SELECT query_id, text FROM q WHERE query_id BETWEEN 5 AND 24",
        "stored_postings": with_(CORPUS) + """
            SELECT term, doc_id, tf, doc_len FROM post JOIN dl USING (doc_id)""",
        "appended_ranking": with_(CORPUS.replace(
            "ts AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf",
            "ts AS (SELECT term, 2 * count(*) AS df, CAST(2 * sum(tf) AS BIGINT) AS ctf").replace(
            "SELECT count(*) FILTER (n_tokens > 0)", "SELECT 2 * count(*) FILTER (n_tokens > 0)").replace(
            "CAST(sum(n_tokens) AS BIGINT) AS total_terms",
            "CAST(2 * sum(n_tokens) AS BIGINT) AS total_terms"), ASKED, matched(),
            f"""s AS (SELECT query_id, doc_id, {six(f"sum(qtf * ({term_score(*JM)}))")} AS score
                FROM m GROUP BY query_id, doc_id)""") + f"""
            SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id
                    ORDER BY score DESC, batch_id, doc_id) AS INTEGER) AS rank, batch_id, doc_id, score
                FROM s, (VALUES (0), (1)) b(batch_id)) WHERE rank <= {CUT}""",
        "judgements_labelled": with_(CORPUS, LABELLED) + "SELECT query_id, doc_id FROM qrels",
        "judgements": with_(QRELS) + "SELECT query_id, doc_id FROM qrels",
        "match": with_(CORPUS, ASKED, matched()) + """
            SELECT query_id, term, qtf, df, ctf, count(*) AS n_matches, CAST(sum(tf) AS BIGINT) AS sum_tf,
                   CAST(sum(doc_len) AS BIGINT) AS sum_doc_len
            FROM m GROUP BY query_id, term, qtf, df, ctf""",
        "relevance_flags": with_(CORPUS, ASKED, QRELS, matched(), RANKED["dir"], flagged()) + """
            SELECT query_id, rank, doc_id, relevant FROM flagged""",
        "ranking_listing": with_(CORPUS, ASKED, QRELS, matched(), RANKED["dir"], flagged()) + """
            SELECT query_id, rank, score, relevant, doc_id, text AS contents
            FROM flagged JOIN documents USING (doc_id)""",
        "first_relevant": with_(CORPUS, ASKED, QRELS, matched(), RANKED["jm"], flagged()) + """
            SELECT query_id, min(rank) FILTER (relevant) AS first_rank,
                   arg_min(doc_id, rank) FILTER (relevant) AS first_doc_id,
                   arg_min(score, rank) FILTER (relevant) AS first_score
            FROM q LEFT JOIN flagged USING (query_id) GROUP BY query_id""",
        "eval_precision": evaluation("dir", "p_value"),
        "eval_recall": evaluation("dir", "r_value"),
        "eval_ap": evaluation("dir", "ap_value"),
        "eval_include_empty": evaluation("jm", "r_value", skip=False),
        "eval_mean": with_(CORPUS, ASKED, QRELS, matched(), RANKED["tfidf"], flagged(), measured()) + f"""
            SELECT count(*) AS n_queries, {six('avg(p_value)')} AS mean_precision,
                   {six('avg(r_value)')} AS mean_recall, {six('avg(ap_value)')} AS mean_average_precision
            FROM measured WHERE n > 0""",
        "sweep_jm": swept("jm") + f"SELECT param, query_id, {six('p_value')} AS value FROM measured",
        "sweep_dir": swept("dir") + f"SELECT param, query_id, {six('r_value')} AS value FROM measured",
        "best_param": swept("dir", f"query_id <= {MIDDLE}") + f""", means AS (
            SELECT param, {six('avg(r_value)')} AS mean FROM measured GROUP BY param)
            SELECT param, mean FROM means WHERE mean > 0 ORDER BY mean DESC, param LIMIT 1""",
        "train_test": trained() + f"SELECT best_param, query_id, {six('r_value')} AS value FROM tested",
        "test_report": trained() + f"""
            SELECT best_param, CAST(query_id AS VARCHAR) AS query, {six('r_value')} AS value FROM tested
            UNION ALL SELECT max(best_param), 'mean', {six('avg(r_value)')} FROM tested""",
        "sweep_table": SWEEP_TABLE,
        "feedback_contents": feedback("tfidf", True) + f"""
            SELECT query_id, round, {six('CAST(hits AS DOUBLE) / got')} AS value, text AS first_contents
            FROM fb LEFT JOIN documents d ON d.doc_id = first_doc_id""",
        "paired_t": T_TEST + f"""
            SELECT pair_id, n, {six('statistic')} AS statistic, {six('p')} AS p_value FROM t_out""",
        "wilcoxon": PAIRS + WILCOXON_CTES + f"""
            SELECT pair_id, n, statistic, {six('p')} AS p_value FROM w_out""",
        "significance_decision": T_TEST + "," + WILCOXON_CTES + """
            SELECT pair_id, 't' AS test, coalesce(p <= 0.05e0, false) AS significant FROM t_out
            UNION ALL SELECT pair_id, 'wilcoxon', coalesce(p <= 0.05e0, false) FROM w_out""",
        "corpus_source": "SELECT doc_id, text || chr(10) AS contents FROM documents",
        "corpus_source_crlf": "SELECT doc_id, text || chr(10) AS contents FROM documents",
        "eval_error_policy": evaluation("dir", "p_value"),
        "query_source": with_(ASKED) + "SELECT query_id, replace(text, chr(10), ' ') AS text FROM q",
        "judgement_source": with_(QRELS) + "SELECT query_id, doc_id FROM qrels",
        "results_source": evaluation("jm", "r_value"),
    }
    for model in RANKED:
        sql[f"rank_{model}"] = with_(CORPUS, ASKED, matched(), RANKED[model]) + rank_cols
    for name, residual in (("feedback_rounds", False), ("feedback_residual", True)):
        sql[name] = feedback("dir", residual) + f"""
            SELECT query_id, round, n_relevant, {six('precisions / n_relevant')} AS value,
                   first_rank, first_doc_id, first_score FROM fb"""
    return sql
