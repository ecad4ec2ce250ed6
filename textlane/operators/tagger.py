"""Trained part-of-speech tags (T5): a bigram hidden Markov tagger.

Training is four aggregates over tagged tokens: tag sizes, tag pairs, (term, tag) and (suffix, tag) counts.  An unseen term
gets the tags of the longest of its last ``SUFFIX`` characters that rare training terms end in, else those of all rare
terms (the back-off of Brants' published trigram tagger).  The best tag sequence (Viterbi) is found for all sequences of
an Arrow batch side by side: its cost is tokens x tags^2, its memory that of the batch's tokens.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Longest suffix looked up, and the most occurrences of a training term whose suffixes are counted.
SUFFIX, RARE = 4, 10
#: Count that a term gets in every tag it was not seen with.
FLOOR = 0.01
#: Most tags: a step holds tags^2 numbers for every sequence of an Arrow batch (whose bytes Spark bounds).
MAX_TAGS = 60


def _suffixes(term):
    """The last 0 to SUFFIX characters of the term."""
    return F.transform(F.sequence(F.lit(0), F.least(F.length(term), F.lit(SUFFIX))), lambda n: F.right(term, n))


def tag_pairs(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(previous, tag, n)`` of neighbouring tags; the first of a sequence has the previous tag ``""``.

    Sequences are joined to themselves by position, so a long one is not one task's window.
    """
    this = tagged.select(F.col(key).alias("_k"), F.col("pos").alias("_p"), "tag")
    before = tagged.select(F.col(key).alias("_k"), (F.col("pos") + 1).alias("_p"), F.col("tag").alias("previous"))
    return (this.join(before, ["_k", "_p"], "left").groupBy(F.coalesce("previous", F.lit("")).alias("previous"), "tag")
            .agg(F.count(F.lit(1)).alias("n")))


def term_tags(tagged: DataFrame) -> DataFrame:
    """``(term, tag, n)``."""
    return tagged.groupBy("term", "tag").agg(F.count(F.lit(1)).alias("n"))


def suffix_tags(counts: DataFrame) -> DataFrame:
    """``(suffix, tag, n)`` over the terms of ``term_tags`` that occur at most RARE times; the empty suffix counts them all."""
    rare = counts.groupBy("term").agg(F.sum("n").alias("_all")).filter(F.col("_all") <= RARE).select("term")
    return (counts.join(rare, "term").select(F.explode(_suffixes(F.col("term"))).alias("suffix"), "tag", "n")
            .groupBy("suffix", "tag").agg(F.sum("n").alias("n")))


def viterbi(scores: list[np.ndarray], start: np.ndarray, step: np.ndarray) -> list[np.ndarray]:
    """Best tag numbers of every sequence, of equal ones the least number at each choice.

    scores: tokens x tags per sequence; start: tags; step: previous x next, all logarithms.
    """
    order = sorted(range(len(scores)), key=lambda k: -len(scores[k]))
    sizes = np.array([len(scores[k]) for k in order])
    live = [k for k in order if len(scores[k])]
    out: list[np.ndarray] = [np.zeros(0, dtype=int)] * len(scores)
    if not live:
        return out
    best = np.array([start + scores[k][0] for k in live])
    back = []
    for t in range(1, int(sizes[0])):
        n = int((sizes > t).sum())   # sequences are sorted: the first n go on
        through = best[:n, :, None] + step
        back.append(through.argmax(axis=1).astype(np.uint8))
        best[:n] = through.max(axis=1) + np.array([scores[k][t] for k in live[:n]])
    for at, k in enumerate(live):
        path = np.empty(len(scores[k]), dtype=int)
        path[-1] = best[at].argmax()
        for t in range(len(path) - 1, 0, -1):
            path[t - 1] = back[t - 1][at, path[t]]
        out[k] = path
    return out


def fit(tagged: DataFrame, key: str = "doc_id") -> dict:
    """The model of ``(key, pos, term, tag)`` rows: tags, start and step scores (at most MAX_TAGS squared), two tables.

    ``terms``: (term, scores) and ``suffixes``: (suffix, scores), one number per tag; both grow with the vocabulary and stay
    DataFrames.  Write them (``session.materialize``) where they are used more than once.
    """
    pairs = tag_pairs(tagged, key).limit(MAX_TAGS * (MAX_TAGS + 1) + 1).collect()   # bounded by the check below
    tags = sorted({r.tag for r in pairs})
    if not tags or len(tags) > MAX_TAGS:
        raise ValueError(f"{len(tags)} tags: the tagger takes 1 to {MAX_TAGS}")
    n = {(r.previous, r.tag): r.n for r in pairs}
    total = {p: sum(n.get((p, t), 0) for t in tags) for p in ["", *tags]}
    step = [[math.log((n.get((p, t), 0) + 1) / (total[p] + len(tags))) for t in tags] for p in ["", *tags]]
    size = {t: sum(n.get((p, t), 0) for p in ["", *tags]) for t in tags}
    share = {t: size[t] / sum(size.values()) for t in tags}

    counts = term_tags(tagged)
    by_term = counts.groupBy("term").pivot("tag", tags).agg(F.sum("n"))
    number = lambda t: F.coalesce(F.col(f"`{t}`"), F.lit(0))
    terms = by_term.select("term", F.array(*[F.log((number(t) + FLOOR) / F.lit(float(size[t]))) for t in tags]).alias("scores"))
    by_suffix = suffix_tags(counts).groupBy("suffix").pivot("tag", tags).agg(F.sum("n"))
    seen = sum((number(t) for t in tags), F.lit(0))
    suffixes = by_suffix.select("suffix", F.array(*[
        F.log((number(t) + share[t]) / (seen + 1) / F.lit(share[t])) for t in tags]).alias("scores"))
    return {"tags": tags, "start": step[0], "step": step[1:], "terms": terms, "suffixes": suffixes}


def tag_scores(vocabulary: DataFrame, model: dict) -> DataFrame:
    """``(term, scores)`` of every distinct term: its own, else its longest known suffix's, else zeros."""
    known = vocabulary.select("term").distinct().join(model["terms"], "term", "left")
    unseen = known.filter(F.col("scores").isNull()).select("term", F.explode(_suffixes(F.col("term"))).alias("suffix"))
    # Short suffixes are shared by many terms: their few rows meet in one left join, split by AQE if hot.
    guess = unseen.join(model["suffixes"], "suffix").groupBy("term").agg(F.max_by("scores", F.length("suffix")).alias("guess"))
    return known.join(guess, "term", "left").select(
        "term", F.coalesce("scores", "guess", F.lit([0.0] * len(model["tags"]))).alias("scores"))


def tag(tokens: DataFrame, model: dict, key: str = "doc_id") -> DataFrame:
    """``(key, pos, term, tag)`` of ``(key, pos, term)`` rows: the best tag sequence of each key, in the order of pos.

    Rows without a term are left out; a null key is a sequence of its own; equal positions go by term.  A term is joined
    with its scores once per occurrence; a sequence is one row of ``tokens x tags`` numbers.
    """
    rows = tokens.filter(F.col("term").isNotNull()).select(key, "pos", "term")
    scored = rows.join(tag_scores(rows, model), "term")
    seq = scored.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "term", "scores"))).alias("seq"))
    tags, start, step = np.array(model["tags"], dtype=object), np.array(model["start"]), np.array(model["step"])

    @F.pandas_udf("array<string>")
    def best(flat: pd.Series) -> pd.Series:
        paths = viterbi([np.asarray(x, dtype=float).reshape(-1, len(tags)) for x in flat], start, step)
        return pd.Series([tags[p] for p in paths])

    flat = F.flatten(F.transform("seq", lambda x: x["scores"]))
    out = seq.select(key, F.transform("seq", lambda x: F.struct(x["pos"].alias("pos"), x["term"].alias("term"))).alias("seq"), best(flat).alias("tags"))
    out = out.select(key, F.explode(F.arrays_zip("seq", "tags")).alias("x"))
    return out.select(key, F.col("x.seq.pos").alias("pos"), F.col("x.seq.term").alias("term"), F.col("x.tags").alias("tag"))
