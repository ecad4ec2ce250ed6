"""Filter audit, vector search and divergence audit: brute-force versions and odd rows on small fixtures."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from textlane.llm import divergence, filter_audit, va_search

DOC = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("h", "part", "bits", "n", "t", "term", "g", "p", "z", "value", "rank", "label", "least", "good", "text_key", "slice", "no", "q", "v")


def with_clashes(df):
    for c in CLASHING:
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.fixture(scope="module")
def rows():
    """Nulls in every column, empty and very long texts, repeated rows, copies, symbols and capitals."""
    rng = random.Random(3)
    word = lambda: rng.choice(["alpha", "Beta", "gamma", "DELTA", "œuvre", "x1", "don't", "ß", "Äpfel", "tail-end", "#tag", "50%"])
    text = lambda n, sep=" ": sep.join(word() for _ in range(n))
    out = [(k, text(rng.choice([3, 30, 60, 200])), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None, ""]), k) for k in range(150)]
    varied = " ".join(f"w{k}" for k in range(80))
    out += [(200 + k, varied, "en", "a" if k % 3 else "b", 1) for k in range(40)]      # copies
    out += [(200, varied, "en", "b", 1), (300, varied, "en", "b", 1), (300, varied + " $", "en", "b", 1), (None, varied, "en", "a", 1)]
    out += [(401, None, "en", "a", None), (400, "", None, None, 0), (402, " \n\t", "en", "zz", 3), (None, None, None, None, None),
            (403, text(90_000, "\n"), "en", "a", 9), (404, "Z" * 400_000 + " one", "de", "c", 9), (405, varied.upper(), "en", "a", 1)]
    return out


# --- 11 ---

def brute_audit(rows, labels):
    good, toxic = ({x[0] for x in labels if x[0] is not None and x[k] == 1} for k in (1, 2))
    least = {}
    for d, text, *_ in rows:
        if d is not None:
            least[text or ""] = min(least.get(text or "", d), d)
    docs = defaultdict(list)
    for d, text, _, source, _ in rows:
        text = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(ws) < 50:
            fails.add("A")
        if 100 * len(set(ws)) < 65 * len(ws):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails.add("C")
        if re.search(r"[#$%&*|]", text):
            fails.add("D")
        if d is not None and least[text] < d:
            fails.add("E")
        docs[source or ""].append((fails, d in good, d in toxic))
    out = {}
    for part, of in docs.items():
        shapley = Counter()
        mine = {}
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [x for x in of if f in x[0] and not x[0] & before]
                shapley[f] += len(gone)
                mine[order, step] = [sum(not x[0] & (before | {f}) for x in of), len(gone), sum(f in x[0] and bool(x[0] & before) for x in of),
                                     sum(x[0] == {f} for x in of), sum(x[1] for x in gone), sum(x[2] for x in gone)]
        for (order, step), v in mine.items():
            out[part, order, step] = (*v, shapley[order[step - 1]])
    return out


def test_filter_audit_equals_brute_force(spark, rows):
    labels = [(k, k % 2, int(k % 7 == 0)) for k in range(0, 420, 3)] + [(3, 0, 1), (6, None, None), (None, 1, 1)]
    docs = with_clashes(spark.createDataFrame(rows, DOC)).repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r[0], r[1], r[2]): tuple(r[3:]) for r in filter_audit.audit(docs, marks).collect()}
    assert got == brute_audit(rows, labels)
    nothing = spark.createDataFrame([], DOC)
    assert filter_audit.audit(nothing, marks).count() == 0
    assert filter_audit.audit(docs, marks.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_equal_hashes_are_not_equal_texts(spark, monkeypatch):
    """With a hash that everything shares, only texts that are equal are copies."""
    monkeypatch.setattr(filter_audit.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    docs = spark.createDataFrame([(1, "a", "en", "s", 1), (2, "b", "en", "s", 1), (3, "a", "en", "s", 1), (4, None, "en", "s", 1), (5, "", "en", "s", 1)], DOC)
    assert sorted(r.doc_id for r in filter_audit.copies_of_smaller(docs).collect()) == [3, 5]


# --- 12 ---

def brute_top(rows, every, k):
    v = {}
    for i, e, *_ in rows:
        if i is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        e = [math.floor(256 * x) for x in e]
        v[i] = min(v.get(i, e), e)
    out = set()
    for q in (i for i in v if i % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(v[q], v[i], strict=False)), i) for i in v if i != q)
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    vec = lambda s=0.2: [float(F32(rng.gauss(0, s))) for _ in range(8)]
    import numpy as np
    F32 = np.float32
    hot, rows = vec(), []
    for k in range(600):
        rows.append((k, hot if k % 3 == 0 else vec(rng.choice([0.05, 0.2, 1.0])), 1))
    rows += [(600, None, 1), (601, [0.1, None] + [0.0] * 6, 1), (602, [float("nan")] * 8, 1), (603, [float("inf")] + [0.0] * 7, 1), (604, [], 1),
             (605, [0.5, -0.5], 1), (None, vec(), 1), (30, rows[30][1], 1), (7, vec(), 1), (-50, vec(), 1), (650, [1e4] * 8, 1), (651, [-1e4] * 8, 1)]
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).repartition(6)
    monkeypatch.setattr(va_search, "BLOCK", 64)
    monkeypatch.setattr(va_search, "QUERIES", 32)
    for every, k, cells in ((10, 5, 64), (10, 5, 2), (50, 1, 8), (200, 2000, 64)):
        got = va_search.top_k(df, every, k, cells).collect()
        assert len(got) == len({tuple(r) for r in got})
        assert {tuple(r) for r in got} == brute_top(rows, every, k)
    for few in (df.limit(0), df.filter("vec_id is null or vec_id = 600"), df.filter("vec_id = 100")):
        assert va_search.top_k(few).count() == 0


def test_approximations_leave_most_vectors_unread(spark):
    """The bounds hold, and they leave few vectors to read."""
    import numpy as np
    rng = np.random.default_rng(4)
    m = np.floor(rng.normal(0, 30, (3000, 16)))
    file = spark.createDataFrame([(k, [int(x) for x in r]) for k, r in enumerate(m)], "no long, v array<long>")
    edges, least, greatest = va_search._edges(file, 16, 64)
    cells = np.stack([np.searchsorted(edges[c], m[:, c], side="right") for c in range(16)], axis=1)
    column = np.arange(16)
    assert (least[column, cells] <= m).all() and (m <= greatest[column, cells]).all()
    lower, upper = va_search._bounds(m[:20], cells, least, greatest)
    exact = m[:20] @ m.T
    assert (lower <= exact).all() and (exact <= upper).all()
    bar = np.sort(lower, axis=1)[:, -6:-5]
    assert (upper >= bar).mean() < 0.05


# --- 13 ---

def brute_divergence(rows, min_docs, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
            for _, text, lang, source, _ in rows]
    df = defaultdict(Counter)
    count = defaultdict(Counter)
    for lang, source, ts in docs:
        df[lang].update(set(ts))
        count[lang, source].update(ts)
    out = set()
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {x[0] for x in docs}:
        kept = {t for t, n in df[lang].items() if n >= min_docs}
        v, mine = len(kept), [s for a, s in count if a == lang]
        total = Counter()
        for s in mine:
            total.update({t: n for t, n in count[lang, s].items() if t in kept})

        def prob(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        q, p = prob(total), {s: prob(count[lang, s]) for s in mine}
        for s in mine:
            ranked = {"pair": [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in mine if o != s],
                      "term": [(-f(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t]]}
            for part, items in ranked.items():
                items = sorted(items)[:top if part == "term" else None]
                out |= {(lang, s, part, i.decode(), -x, r) for r, (x, i) in enumerate(items, 1)}
    return out


def test_divergence_equals_brute_force(spark, rows, monkeypatch):
    docs = with_clashes(spark.createDataFrame(rows, DOC)).repartition(7)
    for min_docs, slice_size, gathered in ((10, 1 << 17, 300_000), (1, 16, 20)):
        monkeypatch.setattr(divergence, "SLICE", slice_size)
        monkeypatch.setattr(divergence, "GATHERED", gathered)
        got = divergence.audit(docs, min_docs).collect()
        assert len(got) == len({tuple(r) for r in got})
        assert {tuple(r) for r in got} == brute_divergence(rows, min_docs, 10)
    bare = divergence.audit(docs, 10 ** 6).collect()                     # no term is kept
    assert {r.value for r in bare} == {0} and {r.part for r in bare} == {"pair"}
    assert divergence.audit(spark.createDataFrame([], DOC)).count() == 0


def test_probability_is_exact_for_large_counts(spark):
    cases = [(10 ** 15, 4 * 10 ** 15, 10 ** 6), (0, 8 * 10 ** 15, 3), (5, 5, 1), (0, 0, 7), (123456789012345, 987654321098765, 31)]
    got = spark.createDataFrame(cases, "c long, n long, v long").select(
        "c", "n", "v", divergence.probability(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()
    assert [r.p for r in got] == [1 + 10 ** 9 * (r.c + 2) // (r.n + 2 * r.v) for r in got]
