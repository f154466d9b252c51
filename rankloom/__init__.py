"""Ranked text retrieval and its evaluation as Spark DataFrame jobs."""

from rankloom.cluster import drop_scratch
from rankloom.functions.models import Model
from rankloom.functions.text import tokens
from rankloom.operators.metrics import first_relevant, mean_value
from rankloom.operators.search import search, show_ranking
from rankloom.operators.terms import query_terms, select_queries
from rankloom.plans.compare import compare
from rankloom.plans.evaluate import evaluate, evaluate_ranking
from rankloom.plans.feedback import feedback, with_contents
from rankloom.plans.tune import best_param, sweep, sweep_table, test_report, train_test
from rankloom.sources.collection import read_corpus, read_qrels, read_queries
from rankloom.sources.index import (Index, build_index, compact, drop_index, open_index,
                                    write_index)
from rankloom.sources.results import read_results, write_results

__all__ = [
    "Index", "Model", "best_param", "build_index", "compact", "compare", "drop_index", "drop_scratch", "evaluate", "evaluate_ranking",
    "feedback", "first_relevant", "mean_value", "open_index", "query_terms", "read_corpus",
    "read_qrels", "read_queries", "read_results", "search", "select_queries", "show_ranking",
    "sweep", "sweep_table", "test_report", "tokens", "train_test", "with_contents",
    "write_index", "write_results",
]
