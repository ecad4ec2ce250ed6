"""Trained tagger: counts by hand, Viterbi against all sequences, accuracy on held-out sentences."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest

from textlane.operators import tagger

TAGS = ("DT", "JJ", "NN", "VB")


def sentences(rng, n):
    """A small grammar; nouns and verbs share stems, so that the neighbour decides."""
    out = []
    for _ in range(n):
        noun = lambda: rng.choice(["report", "claim", "walk", "charge"]) if rng.random() < 0.6 else "n" + str(rng.randrange(500)) + "tion"
        phrase = lambda: [("the", "DT")] + ([("odd" + str(rng.randrange(300)) + "ous", "JJ")] if rng.random() < 0.4 else []) + [(noun(), "NN")]
        out.append(phrase() + [(rng.choice(["report", "claim", "walk", "charge", "make"]), "VB")] + phrase())
    return out


def frame(spark, rows):
    return spark.createDataFrame([(k, p, w, t) for k, s in enumerate(rows) for p, (w, t) in enumerate(s)],
                                 "doc_id long, pos int, term string, tag string")


def test_counts_by_hand(spark):
    rows = sentences(random.Random(1), 40)
    df = frame(spark, rows)
    pairs = Counter((a, b) for s in rows for a, b in zip(["", *[t for _, t in s]], [t for _, t in s], strict=False))
    assert {(r.previous, r.tag): r.n for r in tagger.tag_pairs(df.repartition(5)).collect()} == pairs
    terms = Counter(x for s in rows for x in s)
    got = tagger.term_tags(df)
    assert {(r.term, r.tag): r.n for r in got.collect()} == terms
    size = Counter(w for s in rows for w, _ in s)
    ends = Counter()
    for (w, t), n in terms.items():
        if size[w] <= tagger.RARE:
            for k in range(min(len(w), tagger.SUFFIX) + 1):
                ends[w[len(w) - k:], t] += n
    assert {(r.suffix, r.tag): r.n for r in tagger.suffix_tags(got).collect()} == ends


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(3)
    for _ in range(20):
        k = 3
        start, step = rng.normal(size=k), rng.normal(size=(k, k))
        scores = [rng.normal(size=(n, k)) for n in (4, 0, 1, 6, 2)]
        got = tagger.viterbi(scores, start, step)
        for e, path in zip(scores, got, strict=True):
            value = lambda p: (start[p[0]] if len(p) else 0) + sum(e[i, x] for i, x in enumerate(p)) + sum(  # noqa: E731,B023
                step[a, b] for a, b in itertools.pairwise(p))
            assert len(path) == len(e)
            assert math.isclose(value(path), max(value(p) for p in itertools.product(range(k), repeat=len(e))), abs_tol=1e-9)


def test_held_out_accuracy_and_partitions(spark):
    rng = random.Random(5)
    train, test = sentences(rng, 300), sentences(rng, 100)
    model = tagger.fit(frame(spark, train))
    assert model["tags"] == list(TAGS)
    want = {(k, p): t for k, s in enumerate(test) for p, (_, t) in enumerate(s)}
    df = frame(spark, test).drop("tag")
    got = {(r.doc_id, r.pos): r.tag for r in tagger.tag(df, model).collect()}
    assert got.keys() == want.keys()
    assert sum(got[x] == want[x] for x in want) / len(want) >= 0.98
    # the commonest tag of the term alone does worse: "report" is both noun and verb
    common = {w: Counter(t for s in train for v, t in s if v == w).most_common(1)[0][0] for s in train for w, _ in s}
    assert sum(common.get(w, "NN") == t for s in test for w, t in s) / len(want) < 0.95
    assert got == {(r.doc_id, r.pos): r.tag for r in tagger.tag(df.repartition(7), model).collect()}


def test_odd_rows(spark):
    model = tagger.fit(frame(spark, sentences(random.Random(2), 30)))
    df = spark.createDataFrame([(1, 0, "the"), (1, 1, None), (1, 2, ""), (None, 0, "the"), (None, 0, "the"), (2, 0, "日本")]
                               + [(3, p, "report") for p in range(20000)], "doc_id long, pos int, term string")
    got = Counter(r.doc_id for r in tagger.tag(df, model).collect())
    assert got == {1: 2, None: 2, 2: 1, 3: 20000}
    assert tagger.tag(df.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        tagger.fit(frame(spark, sentences(random.Random(2), 3)).limit(0))
