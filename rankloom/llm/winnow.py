"""Document fingerprints by winnowing, in DataFrame functions only.

A text's words (lower case, without blanks) get hashes; a k-gram's hash is a polynomial of
its words' hashes. Every window of ``window`` k-grams gives its least hash, the rightmost of
equal ones, and the chosen k-grams with their positions are the fingerprint. Windows compare
31 bits; a chosen k-gram gets 31 more from a second polynomial, so that fingerprints of different
k-grams stay apart in a large corpus. Any passage of
``gram + window - 1`` words that two texts share puts a common hash into both fingerprints;
no passage shorter than ``gram`` words does.

Rows: a null text counts as empty; a text without words has an empty fingerprint, one with
fewer than ``gram`` words has the hash of all of them; two empty fingerprints are alike (1).
Texts are read whole. Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom import cluster

GRAM, WINDOW = 5, 6
# Fixed values of the two polynomial hashes: primes below 2^31 and a base.
PRIME, SECOND_PRIME, BASE = 2_147_483_647, 2_147_483_629, 1_000_003
# Positions up to this fit beside a hash in one number; a text has fewer words.
POSITIONS = 1 << 31
# Ids that lie in one stretch are sorted together; stretches grow until there are this many.
STRETCH_IDS, MOST_STRETCHES = 1024, 1_000_000


def word_hashes(text: Column) -> Column:
    """A 64-bit hash per word, in order."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _gram(words: Column, at: Column, gram: int, prime: int = PRIME) -> Column:
    """The hash of ``gram`` words, numbers below the prime, from the zero-based place ``at``."""
    value = F.get(words, at)
    for i in range(1, gram):
        value = (value * F.lit(BASE) + F.get(words, at + i)) % F.lit(prime)
    return value


def _fold_all(words: Column, prime: int = PRIME) -> Column:
    return F.aggregate(words, F.size(words).cast("bigint"), lambda acc, w: (acc * F.lit(BASE) + w) % F.lit(prime))


def _no_longs() -> Column:
    return F.array().cast("array<bigint>")


def _chosen(words: Column, gram: int, window: int) -> Column:
    """The k-grams that windows choose, as numbers ``hash * POSITIONS + (POSITIONS - 1 - place)``.

    The least number of a window is the least hash at its rightmost place.
    """
    last = F.size(words) - gram
    grams = F.transform(F.sequence(F.lit(0), last), lambda i: _gram(words, i, gram) * F.lit(POSITIONS)
                        + (POSITIONS - 1 - i))
    return F.when(F.size(words) == 0, _no_longs()).when(
        last < 0, F.array(_fold_all(words) * F.lit(POSITIONS) + (POSITIONS - 1))).otherwise(_minima(grams, window))


def _below(hashes_: Column, prime: int) -> Column:
    return F.transform(hashes_, lambda h: F.pmod(h, F.lit(prime)))


def _bound(value: Column, of) -> Column:
    """``of`` of an array that is made once however often it is used."""
    return F.flatten(F.transform(F.array(value), lambda bound: F.array(of(bound))))[0]


def marks(hashes_: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The fingerprint of word hashes: a struct of ``places`` and ``hashes``, 62 bits each."""
    def of(h):
        def second(words, place):
            return F.when(F.size(words) < gram, _fold_all(words, SECOND_PRIME)).otherwise(_gram(words, place, gram, SECOND_PRIME))

        def whole(chosen):
            places = F.transform(chosen, lambda m: (POSITIONS - 1 - F.pmod(m, F.lit(POSITIONS))).cast("int"))
            full = _bound(_below(h, SECOND_PRIME), lambda words: F.zip_with(chosen, places, lambda m, place: (
                F.call_function("shiftright", m, F.lit(31)) * F.lit(POSITIONS) + second(words, place))))
            return F.struct(places.alias("places"), full.alias("hashes"))

        return _bound(_bound(_below(h, PRIME), lambda words: _chosen(words, gram, window)), whole)

    return _bound(hashes_, of)


def _minima(grams: Column, window: int) -> Column:
    """The distinct least numbers of all windows, in order of place."""
    # bound to a variable, so that the numbers are made once and not per window
    return F.flatten(F.transform(F.array(grams), lambda g: F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(g) - window + 1)),
        lambda i: F.array_min(F.slice(g, i, window))))))


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Marks of a text column."""
    return marks(word_hashes(F.coalesce(text, F.lit(""))), gram, window)


def shown(marks_: Column) -> Column:
    """A fingerprint as text: ``place:hash``, joined by blanks."""
    return F.array_join(F.zip_with(marks_["places"], marks_["hashes"], lambda p, h: F.concat_ws(
        ":", p.cast("string"), F.hex(h))), " ")


def hashes(marks_: Column) -> Column:
    return F.array_distinct(F.coalesce(marks_["hashes"], _no_longs()))


def likeness(a: Column, b: Column) -> Column:
    """Common share of the distinct hashes of two fingerprints, from 0 to 1."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def _stretches(docs: DataFrame) -> tuple[DataFrame, int]:
    """``(stretch, top_id, above)`` and the width of a stretch of ids.

    ``above`` is the next higher stretch that has ids, and the lowest one for the highest.
    There are at most MOST_STRETCHES, which bounds the one sort and the broadcast of this table.
    """
    ids, width = docs.select("doc_id").filter("doc_id IS NOT NULL"), STRETCH_IDS
    while True:
        tops = cluster.materialise(ids.groupBy(F.expr(f"doc_id div {width}").alias("stretch")).agg(
            F.max("doc_id").alias("top_id")))
        if tops.count() <= MOST_STRETCHES:
            break
        width *= 8
    order = Window.orderBy("stretch")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return tops.select("stretch", "top_id", F.coalesce(
        F.lead("stretch").over(order), F.min("stretch").over(whole)).alias("above")), width


def with_next(docs: DataFrame, marked: tuple[str, ...]) -> DataFrame:
    """``docs(doc_id, ..)`` with ``next_<column>`` of the document of the next lower id.

    The lowest id's next is the highest. Rows that share an id follow one another, and a row
    without an id has no next. A row moves once, to its stretch of ids; the highest row of
    each stretch goes to the stretch above as well, where it only serves as a next.
    """
    tops, width = _stretches(docs)
    named = docs.filter("doc_id IS NOT NULL")
    own = named.select("*", F.expr(f"doc_id div {width}").alias("stretch"), F.lit(1).alias("own"))
    guests = named.join(F.broadcast(tops), F.col("doc_id") == F.col("top_id")).select(
        *docs.columns, F.col("above").alias("stretch"), F.lit(0).alias("own"))
    order = Window.partitionBy("stretch").orderBy("own", "doc_id", *marked)
    joined = own.unionByName(guests).select("*", *(F.lag(c).over(order).alias(f"next_{c}") for c in marked))
    nameless = docs.filter("doc_id IS NULL").select(
        "*", *(F.lit(None).cast(docs.schema[c].dataType).alias(f"next_{c}") for c in marked))
    return joined.filter("own = 1").drop("own", "stretch").unionByName(nameless)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM,
                 window: int = WINDOW) -> DataFrame:
    """``(doc_id, text, marks)`` of every document."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "marks", fingerprint(F.col("text"), gram, window))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM,
                        window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has its last ``floor(n / 2)`` code points replaced by the first as many, or
    all, of the next document in falling order of ids.
    """
    near = with_next(fingerprints(docs, doc_id, text, gram, window), ("text", "marks"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = near.select(
        "doc_id", n.cast("bigint").alias("n_chars"), "marks", "next_marks",
        F.concat(F.substring("text", F.lit(1), n - half), F.substring(
            F.coalesce("next_text", F.lit("")), F.lit(1), half)).alias("edited"))
    done = edited.withColumn("edited_marks", fingerprint(F.col("edited"), gram, window))
    kinds = {c: hashes(F.col(c)) for c in ("marks", "edited_marks", "next_marks")}
    return done.select("doc_id", "n_chars", "edited", "marks", "edited_marks",
                       likeness(kinds["marks"], kinds["edited_marks"]).alias("near_edited"),
                       likeness(kinds["marks"], kinds["next_marks"]).alias("near_next"))
