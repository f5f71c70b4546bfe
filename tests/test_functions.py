"""Scalar functions on literal rows."""

import pytest
from pyspark.sql import functions as F

from marlstone.functions import text as X
from marlstone.functions.links import link_id, link_kind
from marlstone.functions.stemmer import stem


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "given,expected",
    [
        ("A B", "a b"),
        ("en-\n couraged", "encouraged"),
        ("in-class", "inclass"),
        ("ﬁle", "file"),
        ("“No” — ever", '"no" ever'),
        ("a​b­c", "abc"),
        (" x\t\ny ", "x y"),
        (" ", ""),
        (None, ""),
    ],
)
def test_normalize(spark, given, expected):
    assert one(spark, given, X.normalize) == expected


def test_quotes(spark):
    assert one(spark, None, X.as_quotes, "array<string>") == []
    assert one(spark, ["a", " ", None, "b"], X.as_quotes, "array<string>") == ["a", "b"]
    assert one(spark, "one\n\n \n\ntwo", X.split_quotes) == ["one", "two"]
    rows = spark.sql("SELECT parse_json(j) AS v FROM VALUES ('null'), ('\"  \"'), ('\"q\"'), ('[\"a\", 3, \" \", null, \"b\"]'), ('7') AS t(j)")
    assert [r.q for r in rows.select(X.quotes_of_variant(F.col("v")).alias("q")).collect()] == [[], [], ["q"], ["a", "b"], []]


def test_word_likeness(spark):
    english = "the cat and the dog of a house to you in here for all " * 12
    french = "le chat et la maison des amis du village une fois " * 12
    cipher = "xqz vbn wkl prt zzx qqw mnb " * 30
    assert one(spark, "x" * 499, X.looks_like_words) is True
    assert one(spark, english, X.looks_like_words) is True
    assert one(spark, french, X.looks_like_words) is True
    assert one(spark, cipher, X.looks_like_words) is False
    assert one(spark, " the the ", lambda c: X.occurrences(c, " the ")) == 1
    assert one(spark, " the  the ", lambda c: X.occurrences(c, " the ")) == 2


def test_small_functions(spark):
    assert one(spark, "2026 Fall", X.semester_code) == 20269
    assert one(spark, "attachment; filename=\"a+b%20c.pdf\"", X.filename) == "a+b c.pdf"
    assert one(spark, "application/pdf; charset=x", X.media_type) == "application/pdf"
    assert one(spark, "x\nLast updated: May 3\ny", X.last_updated) == "May 3"
    assert one(spark, "none here", X.last_updated) is None
    assert one(spark, bytearray(b"%PDF-1.7"), X.is_pdf, "binary") is True
    assert one(spark, "abc", X.blake2b_64) == "d8bb14d833d59559"
    assert one(spark, "  x  ", X.strip) == "x"
    row = spark.sql("SELECT 1 AS n, 0 AS z, 8 AS t").select(X.pct(F.col("n"), F.col("z")).alias("a"), X.pct(F.col("n"), F.col("t")).alias("b")).first()
    assert (row.a, row.b) == (None, 12.5)


def test_links(spark):
    rows = [("https://x.simplesyllabus.com/doc/abc/",), ("/courses/download/123/",), ("",), (None,)]
    got = spark.createDataFrame(rows, "h string").select(link_kind(F.col("h")).alias("k"), link_id(F.col("h")).alias("i")).collect()
    assert [tuple(r) for r in got] == [("view_simplesyllabus", "abc"), ("download_pdf", "123"), ("none", None), ("none", None)]


@pytest.mark.parametrize(
    "word,expected",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("gas", "gas"), ("this", "this"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("hopping", "hop"), ("hoping", "hope"), ("luxuriating", "luxuri"), ("happy", "happi"), ("relational", "relat"), ("conditional", "condit"),
        ("consistently", "consist"), ("generously", "generous"), ("communism", "communism"), ("skies", "sky"), ("dying", "die"), ("news", "news"), ("national", "nation"), ("adjustment", "adjust"), ("knightly", "knight"), ("policies", "polici"), ("policy", "polici"), ("by", "by"), ("say", "say"),
    ],
)
def test_stem(word, expected):
    assert stem(word) == expected


def test_fuzzy_window():
    body = "students may not use phones in the classroom at any time during the semester"
    assert X.best_window_ratio("students may nat use phones in the classroom", body)
    assert not X.best_window_ratio("laptops are always welcome in the laboratory", body)
