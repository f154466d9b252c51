"""Periodic runs: stretches of words that repeat with a period, three times or more.

A run is a stretch whose smallest period is ``q``, at least ``max(min_words, 3 q)`` words
long, which no neighbouring word extends with that period. By the theorem on runs every
run holds a *Lyndon root*: the longest Lyndon word that begins at some position, for the
order of words or for its reverse. So each position gives two candidates: the longest
Lyndon word from it ends where the next smaller suffix begins. A candidate of length ``q``
at ``i`` is extended both ways by longest common extensions (LCE): to the right that of the
suffixes ``i`` and ``i + q``, to the left that of the prefixes before them.

Extensions are answered in constant time. Ukkonen's algorithm builds the suffix trees of
the words and of their reversal; an Euler tour lists the tree's leaves with, between two
of them, the shallowest node passed; an LCE is the least depth between two leaves, looked
up in a sparse table. The order of the leaves is the order of the suffixes.

Every word of a run lies in some ``GRAM`` words that occur twice in it, a period apart.
Trees are therefore built only over the stretches of a text that repeated grams cover. That
loses nothing: a run lies in one such stretch whole, and what would extend it does too.
Every text is read whole, in one pass that moves no rows; a text is worked on by itself, so
copies and frequent words make no hot task.

Rows: a null or empty text has no words, no runs and nulls for the best one; repeated rows
give the same row each; a null id counts as the empty text where the id is used. A column
that has the name of a result is replaced, others are kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.common import column_bytes, with_columns

MIN_WORDS, LEAST_POWER = 24, 3
# Words that must occur again: a run of MIN_WORDS with three periods has 16 such in a row.
GRAM = 16
_BASE = np.uint64(0x9E3779B97F4A7C15)


class SuffixTree:
    """Ukkonen's tree of a list of numbers from 1 on, which 0 closes.

    Node 0 is the root. ``child`` maps ``node * symbols + first symbol`` to a node;
    ``start`` and ``end`` delimit the words on the edge into a node, an open end is the
    length.
    """

    def __init__(self, codes: list[int], symbols: int):
        s = [*codes, 0]
        n = len(s)
        self.size, self.symbols = n, symbols
        start, end, link, child = [0], [0], [0], {}
        node, edge, length, left = 0, 0, 0, 0
        for i, c in enumerate(s):
            left += 1
            fresh = 0  # the inner node that waits for its link
            while left:
                if not length:
                    edge = i
                at = child.get(node * symbols + s[edge])
                if at is None:
                    child[node * symbols + s[edge]] = len(start)
                    start.append(i), end.append(n), link.append(0)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    begin = start[at]
                    span = min(end[at], i + 1) - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = at
                        continue
                    if s[begin + length] == c:
                        length += 1
                        if fresh:
                            link[fresh] = node
                        break
                    split = len(start)
                    start.append(begin), end.append(begin + length), link.append(0)
                    child[node * symbols + s[edge]] = split
                    child[split * symbols + c] = split + 1
                    start.append(i), end.append(n), link.append(0)
                    start[at] = begin + length
                    child[split * symbols + s[begin + length]] = at
                    if fresh:
                        link[fresh] = split
                    fresh = split
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - left + 1
        self.start, self.end, self.child = start, end, child

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of the leaves, and the depths passed between neighbours.

        ``falling`` turns the order of the words round; the close of the text stays first.
        """
        keys = np.fromiter(self.child.keys(), np.int64, len(self.child))
        nodes = np.fromiter(self.child.values(), np.int64, len(self.child))
        parents, symbols = np.divmod(keys, self.symbols)
        if falling:
            symbols = np.where(symbols > 0, self.symbols - symbols, 0)
        order = np.lexsort((-symbols, parents))  # the stack turns children round again
        kids = nodes[order].tolist()
        first = np.searchsorted(parents[order], np.arange(len(self.start) + 1)).tolist()
        width = [b - a for a, b in zip(self.start, self.end)]
        depth, up = [0] * len(width), [0] * len(width)
        leaves, passed, least = [], [], 0
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:  # back at an inner node, from one of its children
                if depth[~v] < least:
                    least = depth[~v]
                continue
            depth[v] = d = depth[up[v]] + width[v]
            own = kids[first[v]:first[v + 1]]
            for k in own:
                up[k] = v
                stack.append(~v)
                stack.append(k)
            if not own:
                leaves.append(self.size - d)
                passed.append(least)
                least = d
        return np.array(leaves), np.array(passed[1:], np.int64)


def ranks(leaves: np.ndarray) -> np.ndarray:
    """Each suffix's place in the order of the leaves."""
    out = np.empty(len(leaves), np.int64)
    out[leaves] = np.arange(len(leaves))
    return out


class Extensions:
    """Longest common extensions of the suffixes of a tree, from its tour."""

    def __init__(self, leaves: np.ndarray, between: np.ndarray):
        self.rank = ranks(leaves)
        self.table = [between.astype(np.int32)]
        while 2 << (len(self.table) - 1) <= len(between):
            step, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common words from ``a`` and ``b`` on; the two differ."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            m = level == k
            t = self.table[k]
            out[m] = np.minimum(t[low[m]], t[high[m] - (1 << int(k))])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every position the next one with a smaller rank."""
    values = rank.tolist()
    out, stack = [len(values)] * len(values), []
    for i, r in enumerate(values):
        while stack and values[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(codes: list[int], min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a list of numbers from 1 on, in order."""
    n = len(codes)
    if n < min_words:
        return []
    symbols = max(codes) + 1
    tree = SuffixTree(codes, symbols)
    leaves, between = tree.tour()
    ahead = Extensions(leaves, between)
    candidates = []
    at = np.arange(n)
    for rank in (ahead.rank, ranks(tree.tour(falling=True)[0])):
        candidates.append(np.stack([at, next_smaller(rank)[:n] - at]))
    del tree
    behind = Extensions(*SuffixTree(codes[::-1], symbols).tour())
    i, q = np.unique(np.concatenate(candidates, axis=1), axis=1)
    short = LEAST_POWER * q <= n
    i, q = i[short], q[short]
    # the reversal's suffix n - k reads backwards from word k - 1; 0 is the close of either text
    right = ahead.lce(i, i + q)
    left = behind.lce(n - i, n - i - q)
    length = left + q + right
    kept = length >= np.maximum(min_words, LEAST_POWER * q)
    found = np.unique(np.stack([i[kept] - left[kept], length[kept], q[kept]], axis=1), axis=0)
    return [tuple(map(int, r)) for r in sorted(found.tolist(), key=lambda r: (r[0], r[2]))]


def covered_stretches(codes: np.ndarray, gram: int = GRAM) -> list[tuple[int, int]]:
    """The longest stretches made of grams that occur more than once."""
    m = len(codes) - gram + 1
    if m < 2:
        return []
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * _BASE
    mixed ^= mixed >> np.uint64(31)
    hashes, power = np.zeros(m, np.uint64), _BASE | np.uint64(1)
    for k in range(gram):
        hashes = hashes * power + mixed[k:k + m]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    again = np.zeros(m + 1, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    if not again.any():
        return []
    cover = np.zeros(len(codes) + 1, np.int64)
    places = np.nonzero(again)[0]
    cover[places] += 1
    cover[places + gram] -= 1
    inside = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
    edges = np.nonzero(inside[1:] != inside[:-1])[0]
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def text_runs(codes: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """``runs_of`` of a whole text."""
    found = []
    gram = max(1, min(GRAM, 2 * min_words // LEAST_POWER))
    for a, b in covered_stretches(codes, gram):
        if b - a >= min_words:
            _, own = np.unique(codes[a:b], return_inverse=True)
            found += [(a + start, length, period) for start, length, period in runs_of((own + 1).tolist(), min_words)]
    return found


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray | None:
    """Which words no run holds after its first period; None for all of them."""
    if not runs:
        return None
    cover = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return np.cumsum(cover[:n]) == 0


def coded(data: bytes | None) -> tuple[list[bytes], np.ndarray]:
    """The words of a text, and a number per different word."""
    words = data.split() if data else []
    numbers: dict[bytes, int] = {}
    return words, np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


FIELDS = T.StructType([
    T.StructField("runs", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())]))),
    T.StructField("collapsed", T.BinaryType())])


def find_runs(docs: DataFrame, text: str = "text", rewrite=None, min_words: int = MIN_WORDS,
              digest: bool = False) -> DataFrame:
    """``docs`` with its ``runs`` and the ``collapsed`` text, one blank between its words.

    ``rewrite(row, n)`` may give the numbers of the words that stand in a text's places;
    ``row`` holds the other columns. With ``digest`` the collapsed text is only its SHA-256.
    """
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def start():
        def step(piece):
            rows = piece.drop_columns([text]).to_pylist() if rewrite else [None] * piece.num_rows
            found, texts = [], []
            for data, row in zip(column_bytes(piece, text), rows):
                words, codes = coded(data)
                places = rewrite(row, len(words)) if rewrite else None
                if places is not None:
                    codes = codes[places]
                runs = text_runs(codes, min_words)
                kept = kept_words(len(words), runs)
                if places is not None or kept is not None:
                    at = np.arange(len(words)) if places is None else places
                    words = [words[i] for i in (at if kept is None else at[kept]).tolist()]
                joined = b" ".join(words)
                texts.append(hashlib.sha256(joined).digest() if digest else joined)
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
            return [pa.array(found, pa.list_(kind)), pa.array(texts, pa.binary())]
        return step

    return with_columns(docs, text, FIELDS, start)


def by_power(a: Column, b: Column) -> Column:
    """Order of runs for ``array_sort``: by falling length over period, exactly, then as they stand."""
    more, less = a["length"] * b["period"], b["length"] * a["period"]
    later = F.when(a["start"] != b["start"], a["start"] > b["start"]).otherwise(a["period"] > b["period"])
    same = (a["start"] == b["start"]) & (a["period"] == b["period"])
    return F.when(more > less, -1).when(more < less, 1).when(same, 0).when(later, 1).otherwise(-1)
