import pytest
from pyspark.sql import functions as F

from rankloom.functions.text import quantised_length, tokens

CASES = {
    "O'Neil's 3.14, u.s.a. self-adjusting": ["o'neil's", "3.14", "u.s.a", "self", "adjusting"],
    "a1.b 1.2a.b x:y 7:30 1,000;5": ["a1", "b", "1.2a.b", "x:y", "7", "30", "1,000;5"],
    "foo_bar _x __ -- …": ["foo_bar", "_x"],
    "ÁRBOL Ñandú naïve": ["árbol", "ñandú", "naïve"],
    "東京 tower ひら ハングル 한국어": ["東", "京", "tower", "ひ", "ら", "ハングル", "한국어"],
    "été l’eau": ["été", "l’eau"],
    "カタカナabc abcカナ1": ["カタカナ", "abc", "abc", "カナ", "1"],
    "カナ_a a_カナ_b _カナ カ.a": ["カナ_a", "a_カナ_b", "_カナ", "カ", "a"],
    "ｶﾞﾅ ー ㌀": ["ｶﾞﾅ", "ー", "㌀"],
    "abcไทย ไทยไทย 12ไทย": ["abc", "ไทย", "ไทยไทย", "12", "ไทย"],
    "မြန်မာ x": ["မြန်မာ", "x"],
    "한글abc 漢abc": ["한글abc", "漢", "abc"],
    "ok 😀👍🏽! x😀y": ["ok", "😀", "👍🏽", "x", "😀", "y"],
    "👩‍👩‍👧‍👦 ❤️ 🏳️‍🌈": ["👩‍👩‍👧‍👦", "❤️", "🏳️‍🌈"],
    "🇪🇸🇫🇷 🇪 1️⃣ #️⃣ # *": ["🇪🇸", "🇫🇷", "1️⃣", "#️⃣"],
    "": [],
    " .,; \n\t": [],
    "x" * 600: ["x" * 255, "x" * 255, "x" * 90],
    "a" * 254 + ".b": ["a" * 254, "b"],
}


def test_tokens(spark):
    rows = [(i, text) for i, text in enumerate(CASES)]
    got = {r.i: r.words for r in spark.createDataFrame(rows, "i int, text string").select(
        "i", tokens("text").alias("words")).collect()}
    for i, (text, words) in enumerate(CASES.items()):
        assert got[i] == words, text


def test_very_long_word_does_not_overflow(spark):
    text = "ñ." * 200_000
    row = spark.createDataFrame([(text,)], "text string").select(
        F.size(tokens("text")).alias("n"), F.array_max(F.transform(tokens("text"), F.length)).alias("m")).first()
    assert row.m <= 255 and row.n >= len(text) // 256


def one_byte(length: int) -> int:
    """The bit-level definition: three bits after the leading one are kept above 24."""
    over = length - 24
    if length < 24 or over.bit_length() < 4:
        return length
    drop = over.bit_length() - 4
    return 24 + (over >> drop << drop)


def test_length_code(spark):
    got = spark.range(0, 20_000).select("id", quantised_length(F.col("id")).alias("code")).collect()
    assert all(r.code == one_byte(r.id) for r in got)
    known = {39: 39, 40: 40, 41: 40, 55: 54, 56: 56, 59: 56, 88: 88, 100: 96, 1000: 984}
    assert {r.id: r.code for r in got if r.id in known} == known


@pytest.mark.parametrize("kind,param", [("jm", 0), ("jm", 1.5), ("jm", None), ("dir", -1), ("bm25", 1)])
def test_bad_models(kind, param):
    from rankloom import Model
    with pytest.raises(ValueError):
        Model(kind, param)


def test_words_before_blanks_and_signs(spark):
    """Plain letters end where no class could go on: the same words as by the full classes."""
    from rankloom.functions import text as module
    assert module._END in module.WORD and module._BEGIN in module.WORD
    cases = {"a. b, c; d: e": ["a", "b", "c", "d", "e"], "a.b 1,2 a.1 für über.": ["a.b", "1,2", "a", "1", "für", "über"],
             "á b‍ c!d (e) fカ 1️⃣ 2": ["á", "b‍", "c", "d", "e", "f", "カ", "1️⃣", "2"],
             "a.\nb a., b a÷b a×b": ["a", "b", "a", "b", "a", "b", "a", "b"]}
    got = {r.text: r.words for r in spark.createDataFrame([(t,) for t in cases], "text string").select("text", tokens("text").alias("words")).collect()}
    assert got == cases
