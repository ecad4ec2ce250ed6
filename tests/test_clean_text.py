"""Golden rows for cleaning and text operators (FIXTURES C1-C3, C12)."""

from pyspark.sql import functions as F

from textlane.functions.stem import stem_table
from textlane.operators import clean, text


def test_build_tickets_null_rules(spark):
    rows = [(1, "Hi", "Loan", "Car"), (2, "Hi", "Loan", None), (3, "", "Loan", "Car"),
            (4, None, "Loan", "Car"), (5, " ", "Loan", "Car"), (6, "Hi", "", "Car")]
    df = spark.createDataFrame(rows, "id int, c string, p string, s string")
    out = {r.id: r.ticket_classification for r in clean.build_tickets(df, "c", "p", "s", keep=("id",)).collect()}
    assert out == {1: "Loan + Car", 5: "Loan + Car", 6: " + Car"}


def test_mask_strip_order(spark):
    cases = {"xx/xx/2019 loan": "2019 loan", "xxxx loan": " loan", "xxxxx": "x", "xxxxxxxx": "", "box/y": "boy"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.o for r in df.select("t", clean.strip_masks(F.col("t")).alias("o")).collect()}
    assert got == cases


def test_stopwords_keep_order_and_duplicates(spark):
    df = spark.createDataFrame([(1, ["The", "bank", "and", "the", "bank"])], "id int, tokens array<string>")
    got = text.remove_stopwords(df, words=("the", "and")).first().tokens
    assert got == ["bank", "bank"]


def test_tokenize_words(spark):
    df = spark.createDataFrame([(1, "Don't pay 2 fees, café-owners! a_b")], "doc_id int, text string")
    assert text.tokenize(df).first().tokens == ["don", "pay", "fees", "café", "owners", "a_b"]


def test_bround_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,)], "x double")
    assert [r.y for r in df.select(F.bround("x", 2).alias("y")).collect()] == [0.12, 0.38]


def test_stemmer_published_pairs(spark):
    pairs = {"caresses": "caress", "ponies": "poni", "ties": "tie", "hopping": "hop", "relational": "relat",
             "generously": "generous", "skies": "sky", "dying": "die", "controll": "control", "by": "by",
             "crying": "cri", "knightly": "knight", "consistency": "consist", "succeeding": "succeed"}
    df = spark.createDataFrame([(k,) for k in pairs], "term string")
    assert {r.term: r.stem for r in stem_table(df).collect()} == pairs


def test_rebuild_text_keeps_position_order(spark):
    df = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, "b"), (2, 0, "z")], "doc_id int, pos int, term string")
    got = {r.doc_id: r.processed_text for r in text.rebuild_text(df.repartition(3)).collect()}
    assert got == {1: "a b c", 2: "z"}


def test_dense_index_is_dense(spark):
    df = spark.range(0, 1000, 7).withColumnRenamed("id", "k")
    out = clean.dense_index(df, "k", "i", partitions=5).orderBy("k").collect()
    assert [r.i for r in out] == list(range(len(out)))
