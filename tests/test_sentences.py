"""Abbreviations learned from a corpus; golden sentences."""

import math

import pytest

from textlane.operators import sentences as st

CORPUS = (["Dr. Maria saw Mr. Lee at 5 p.m. today. He paid. Then he left the bank.", "Dr. Lee met Dr. Maria. The bank was shut.",
           "Mr. Lee asked Mr. Maria. He paid the bank at 3 p.m. and left."] * 4
          + ["The bank was shut today and he left. Maria paid. Lee paid the bank and left today."] * 4)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, "en", t) for k, t in enumerate(CORPUS)] + [(100, "en", None), (101, "en", ""), (102, None, "Dr. Who? Nobody! ok"), (103, "en", "  ")]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string")


def test_scores_follow_the_formula(docs):
    got = {r.type: r for r in st.type_scores(docs).collect() if r.lang == "en"}
    assert got["dr"].n == got["dr"].n_period == 12 and got["p.m"].n_period == 8
    import re
    words = [w for t in CORPUS for w in re.findall(r"\w+(?:\.\w+)*\.?", t)]
    share = sum(w.endswith(".") for w in words) / len(words)
    left = [w for w in words if w.lower().rstrip(".") == "left"]
    with_period = sum(w.endswith(".") for w in left)
    without = len(left) - with_period
    ratio = -2 * (with_period * math.log(share) + without * math.log(1 - share) - with_period * math.log(0.99) - without * math.log(1 - 0.99))
    assert math.isclose(got["left"].score, ratio * math.exp(-4) * 1 * 4 ** -without, rel_tol=1e-9)
    assert {(r.lang, r.type) for r in st.abbreviations(docs).collect()} >= {("en", "dr"), ("en", "mr"), ("en", "p.m")}
    assert ("en", "left") not in {(r.lang, r.type) for r in st.abbreviations(docs).collect()}


def test_golden_sentences(docs):
    known = docs.sparkSession.createDataFrame([("en", "dr"), ("en", "mr"), ("en", "p.m")], "lang string, type string")
    rows = st.split_sentences(docs.repartition(5), known).orderBy("doc_id", "sentence_no").collect()
    of = lambda k: [r.sentence for r in rows if r.doc_id == k]
    assert of(0) == ["Dr. Maria saw Mr. Lee at 5 p.m. today.", "He paid.", "Then he left the bank."]
    assert of(1) == ["Dr. Lee met Dr. Maria.", "The bank was shut."]
    assert of(100) == [] and of(101) == [] and of(103) == ["  "]
    assert of(102) == ["Dr.", "Who?", "Nobody! ok"]                # a language of its own, without abbreviations
    assert [r.sentence_no for r in rows if r.doc_id == 0] == [0, 1, 2]
    tokens = {r.sentence_no: r.tokens for r in st.sentence_tokens(st.split_sentences(docs.filter("doc_id = 1"), known)).collect()}
    assert tokens[1] == ["the", "bank", "was", "shut", "."]
    assert st.split_sentences(docs.limit(0), known).count() == 0 and st.type_scores(docs.limit(0)).count() == 0
