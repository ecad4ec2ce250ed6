"""Training-data operators: edge cases, brute-force versions and properties on small fixtures."""

import datetime as dt
import hashlib
import math
import random
import re
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textlane.llm import (decontaminate, jaccard_join, licenses, line_dedup, mixing, quality_lines, sharding, style_tree,
                          url_rules, warc)
from textlane.llm.common import hashed_words

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{k}" for k in range(400)]


def words(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    rng = random.Random(5)
    long_text = "\n".join(" ".join(words(rng, 20)) for _ in range(3000))
    plain = " ".join(words(rng, 60))
    rows = [(1, plain, "en", "a", 1), (1, plain, "en", "a", 1), (2, plain, "en", "b", 1), (3, None, "en", "a", None),
            (4, "", None, None, 0), (5, " \n\t", "en", "a", 3), (None, plain + " x", "en", "a", 1), (6, long_text, "en", "a", 9),
            (7, "one two", "en", None, 7), (8, "Zeile äÄ\n\nzeile ÄÄ ", "de", "", 2), (9, plain.upper(), "en", "a", 1)]
    df = spark.createDataFrame(rows, DOC)
    for c in ("size", "shard", "slot", "kept", "piece", "part", "h", "row", "key", "set_id", "label", "n", "file", "path", "_time"):
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def test_word_hashes_do_not_depend_on_place():
    rng = random.Random(1)
    texts = [" ".join(words(rng, rng.randrange(0, 50))) for _ in range(200)] + ["x" * 600_000 + " y", "a b " * 200_000, ""]
    raws = [t.encode() for t in texts]
    got = list(hashed_words(raws))
    assert [len(g) for g in got] == [len(r.split()) for r in raws]
    one = {}
    for raw, hashes in zip(raws, got, strict=True):
        for w, h in zip(raw.split(), hashes.tolist(), strict=True):
            assert one.setdefault(w, h) == h
    assert len(set(one.values())) == len(one)


# --- 1 ---

def test_revisits(spark):
    t = lambda m: dt.datetime(2024, 1, 1, 0, m)
    rows = [
        (1, "http://www.A.org/x/?utm_source=q#f", t(1), "response", {"etag": '"1"', "content-type": "text/html", "server": "s"}),
        (2, "https://a.org/x", t(5), "response", {"etag": '"2"', "last-modified": "d"}),
        (3, "http://a.org/x", t(5), "revisit", {"etag": 'W/"1"', "server": "new", "content-type": "message/http"}),
        (4, "http://a.org/x", t(9), "revisit", {"etag": '"1"'}),
        (5, "http://a.org/x", t(59), "revisit", {"last-modified": "d"}),
        (6, "http://a.org/x", t(59), "revisit", None),
        (7, "http://b.org/", t(3), "revisit", {"etag": "e"}), (8, None, t(3), "revisit", None), (9, "http://a.org/x", None, "revisit", None),
        (4, "http://a.org/x", t(9), "revisit", {"etag": '"1"'}), (10, "http://a.org/x", t(2), "metadata", None)]
    df = spark.createDataFrame(rows, "record_id long, url string, ts timestamp, kind string, headers map<string,string>")
    df = df.withColumn("piece", F.lit(0)).withColumn("origin", F.lit("clash"))
    for piece in (60, 3600, 10 ** 6):
        out = warc.resolve_revisits(df, piece_seconds=piece).collect()
        got = sorted(((r.record_id, r.origin_id, r.status) for r in out), key=str)
        assert got == sorted([(3, 1, "etag"), (4, 2, "mismatch"), (4, 2, "mismatch"), (5, 2, "last-modified"), (6, 2, "unchecked"),
                              (7, None, "no-origin"), (8, None, "no-origin"), (9, None, "no-origin")], key=str)
        merged = next(r.headers for r in out if r.record_id == 3)
        assert merged == {"etag": 'W/"1"', "content-type": "text/html", "server": "new"}
    assert warc.resolve_revisits(df.limit(0)).count() == 0


# --- 2 ---

def brute_classes(texts, threshold=0.8):
    sets = [frozenset(s.tolist()) for s in jaccard_join.shingle_sets(texts)]
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    links = Counter()
    distinct = {s: k for k, s in reversed(list(enumerate(sets)))}
    for k, s in enumerate(sets):
        for j in range(k):
            t = sets[j]
            if s and t and len(s & t) >= threshold * len(s | t) - 1e-9:
                up[max(root(k), root(j))] = min(root(k), root(j))
                if s != t and distinct[s] == k and distinct[t] == j:
                    links[s] += 1
                    links[t] += 1
    return [root(k) for k in range(len(texts))], [links[s] for s in sets]


def near_copies(seed, groups=40, size=6):
    rng, out = random.Random(seed), []
    for _ in range(groups):
        base = words(rng, 120)
        out.append(" ".join(base))
        for _ in range(rng.randrange(size)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = "edit"
            out.append(" ".join(copy))
    return out


def test_jaccard_join_against_brute_force(spark, monkeypatch):
    texts = near_copies(3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes, links = brute_classes(texts)
    got = {r.doc_id: r for r in jaccard_join.jaccard_join(df).collect()}
    assert sum(links) > 100
    assert sum(got[k].n_links for k in got) >= 0.97 * sum(links)
    assert sum(got[k].class_id != c for k, c in enumerate(classes)) <= 0.02 * len(texts)
    # one bucket of near copies that is larger than a block: split by paths, then compared in blocks
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    rng = random.Random(9)
    base = words(rng, 150)
    big = [" ".join([*base[:k], "edit", *base[k + 1:]]) for k in range(0, 150, 2)]
    df = spark.createDataFrame(list(enumerate(big)), "doc_id long, text string")
    out = jaccard_join.jaccard_join(df).collect()
    assert {r.class_id for r in out} == {0}
    assert {r.doc_id: r.n_links for r in out} == dict(enumerate(brute_classes(big)[1]))


def test_two_blocks_of_near_copies_give_one_edge():
    import numpy as np
    import pyarrow as pa

    def edges(places, a, b):
        rows = [(k, 0 if k < 20 else 1) for k in places]
        sig = lambda k: np.full(jaccard_join.TOKENS, 7 if k % 20 < 18 else k, dtype=np.uint16).tobytes()
        batch = pa.RecordBatch.from_pylist([{"path": 1, "a": a, "b": b, "own": own, "set_id": k, "sig": sig(k)} for k, own in rows])
        return [(r["u"], r["v"]) for out in jaccard_join._near(0.8)(iter([batch])) for r in out.to_pylist()]

    inner = edges(range(20), 0, 0) + edges(range(20, 40), 1, 1)
    assert len(inner) == 34 and len(edges(range(40), 0, 1)) == 1
    seen = {0}
    for _ in range(40):
        seen |= {x for e in inner + edges(range(40), 0, 1) if seen & set(e) for x in e}
    assert seen == {k for k in range(40) if k % 20 < 18}


def test_jaccard_join_odd_rows(odd, empty):
    out = jaccard_join.jaccard_join(odd).collect()
    assert len(out) == odd.count() and jaccard_join.jaccard_join(empty).count() == 0
    by = {r.doc_id: r for r in out}
    assert by[2].class_id == by[9].class_id == by[None].class_id == 1 and by[9].n_copies == 4
    assert by[3].class_id == 3 and by[4].class_id == 4 and by[5].class_id == 5 and by[3].n_links == 0


# --- 3, 4 ---

def test_line_frequency(spark, odd, empty):
    out = quality_lines.judge(odd).collect()
    assert len(out) == odd.count() and quality_lines.judge(empty).count() == 0
    by = {r.doc_id: r for r in out}
    assert by[3].n_words == 0 and by[3].base_failed and not by[3].kept and by[1].kept and by[6].kept
    common = "terms of use apply to this page and all others here"
    rng = random.Random(2)
    rows = [(k, common + "\n" + " ".join(words(rng, 40)), "en", "a", 0) for k in range(30)]
    rows += [(100 + k, "\n".join([common.upper()] * 9) + "\n" + " ".join(words(rng, 12)), "en", "a", 0) for k in range(3)]
    rows += [(200 + k, rows[0][1], "en", "b", 0) for k in range(50)]   # copies of one text don't make its lines common
    out = {r.doc_id: r for r in quality_lines.judge(spark.createDataFrame(rows, DOC), min_docs=10).collect()}
    assert all(out[k].kept and out[k].removed_words == 11 for k in range(30))
    assert all(not out[100 + k].kept and out[100 + k].removed_words == 99 for k in range(3))
    assert all(out[200 + k].kept and out[200 + k].removed_words == 0 for k in range(50))
    stripped = quality_lines.strip_common_lines(spark.createDataFrame(rows[:30], DOC)).collect()
    assert sorted(r.kept_text for r in stripped) == sorted(t.split("\n")[1] for _, t, *_ in rows[:30])


def test_line_frequency_does_not_loosen_as_the_host_grows(spark):
    rng = random.Random(3)
    common = " ".join(f"boilerplate{k}" for k in range(40))
    group = [common + "\n" + " ".join(words(rng, 12)) for _ in range(12)]
    rows = [(k, t, "en", "small", 0) for k, t in enumerate(group)] + [(100 + k, t, "en", "large", 0) for k, t in enumerate(group)]
    rows += [(1000 + k, " ".join(words(rng, 25)), "en", "large", 0) for k in range(1500)]
    out = {r.doc_id: r for r in quality_lines.judge(spark.createDataFrame(rows, DOC)).collect()}
    assert all((out[k].removed_words, out[k].kept) == (out[100 + k].removed_words, out[100 + k].kept) == (40, False) for k in range(12))
    assert all(r.kept and r.removed_words == 0 for k, r in out.items() if k >= 1000)


def test_repeat_words():
    text = ("a b c d e f g h " * 2 + "x y z").strip()
    raw = text.encode()
    n, chars, _, _, repeated = quality_lines.text_metrics(text, raw, next(hashed_words([raw])))
    assert (n, chars, repeated) == (19, 19, 16)


def test_line_dedup(spark, odd, empty):
    assert line_dedup.dedup_lines(empty).count() == 0
    out = line_dedup.dedup_lines(odd, min_docs=2).collect()
    assert len(out) == odd.count()
    by = {r.doc_id: r for r in out}
    assert (by[3].n_lines, by[3].n_dropped, by[3].kept) == (1, 0, "")
    assert by[2].kept == "" and by[2].n_dropped == 1 and by[6].n_dropped == 0 and by[8].kept == "Zeile äÄ\n\nzeile ÄÄ "
    rows = [(k, f" Same Line \nown {k}\n\nsame line", None, None, None) for k in range(9)]
    some = spark.createDataFrame([*rows, rows[0]], DOC)   # a repeated row is one document
    assert {r.kept for r in line_dedup.dedup_lines(some).collect()} == {r[1] for r in rows}
    some = spark.createDataFrame([*rows, (9, "x\nSAME LINE", None, None, None)], DOC)
    got = {r.doc_id: (r.n_dropped, r.kept) for r in line_dedup.dedup_lines(some).collect()}
    assert got == {k: (2, f"own {k}\n") for k in range(9)} | {9: (1, "x")}


# --- 5 ---

def test_line_frequency_equals_its_sql_on_a_large_host(spark):
    """One host of 2,000 texts: a line in 12 of them is above the limit whatever the host's size."""
    import duckdb

    from textlane.llm.queries import ORACLE
    rng = random.Random(12)
    rows = []
    for k in range(2000):
        body = "\n".join(" ".join(f"v{rng.randrange(5000)}" for _ in range(12)) for _ in range(3))
        shared = ["all of these words stand on a line that twelve texts of this host have in common " * 5] if k < 12 else []
        shared += ["nine texts have this"] if k < 9 else []
        rows.append((k, "\n".join([body, *shared]), "en", "host", 1))
    df = spark.createDataFrame(rows, DOC)
    got = {tuple(r[c] for c in sorted(r.asDict())) for r in quality_lines.judge(df).drop("text_in_host").collect()}
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    cur = con.execute(ORACLE["op3_line_frequency"])
    at = sorted(range(len(cur.description)), key=lambda i: cur.description[i][0])
    assert got == {tuple(r[i] for i in at) for r in cur.fetchall()}
    assert sum(r.removed_words > 0 for r in quality_lines.judge(df).collect()) == 12


def test_url_rules(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/es/ok", "allow"), ("com", "/de/", "block"),
             ("com", "/de/", "block"), ("x.com", "/", "allow"), (None, "/", "block")]
    urls = ["http://a.EXAMPLE.org/es/1", "http://example.org/es/ok/2", "https://other.org/q?z", "http://org", "ftp://x.com/de/1",
            "http://notexample.org/es/", "http://y.com/DE/", "no scheme/de/", None, "http://a.b.x.com/de/9#f", "http:///de/"]
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = [(k, u) for k, u in enumerate(urls)] + [(0, urls[0]), (None, "http://z.com/de/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit("clash"))

    def expect(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = rest.split("/")[0].split("?")[0].split("#")[0].lower()
        path = rest[len(host):].split("?")[0].split("#")[0]
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fit)[2], max(fit)[3]) if fit else (host, path, None, "allow")
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = sorted((str(x.page_id), x.host, x.path, str(x.rule), x.verdict) for x in url_rules.judge_urls(pages, r).collect())
        assert got == sorted((str(k), *(str(y) if i == 2 else y for i, y in enumerate(expect(u)))) for k, u in rows)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    # characters of the host that look like the parts of a key
    odd_pages = spark.createDataFrame([(1, "http://org\x01example/es/x"), (2, "http://example.org\x02/es/x"), (3, "http://org?example#/es/x"),
                                       (4, "http://a.example.org/es/x")], "page_id long, url string")
    odd_rules = spark.createDataFrame([("example.org", "/es/", "block"), ("org?example", "/", "block"), ("org#", "", "block")],
                                      "host string, path string, verdict string")
    assert {x.page_id: x.verdict for x in url_rules.judge_urls(odd_pages, odd_rules).collect()} == {
        1: "allow", 2: "allow", 3: "allow", 4: "block"}
    assert url_rules.judge_urls(pages.limit(0), r).count() == 0
    assert {x.verdict for x in url_rules.judge_urls(pages, r.limit(0)).collect()} == {"allow"}


# --- 6, 10 ---

def test_sainte_lague_against_greedy(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for g in range(30):
        claims = [rng.choice([0.0, rng.random(), 50 * rng.random()]) for _ in range(rng.randrange(1, 8))]
        seats = rng.randrange(0, 40)
        won = [0] * len(claims)
        for _ in range(seats if sum(claims) else 0):
            best = max(range(len(claims)), key=lambda k: (claims[k] / (2 * won[k] + 1), -k))
            won[best] += 1
        rows += [(g, k, c, seats) for k, c in enumerate(claims)]
        want |= {(g, k): n for k, n in enumerate(won)}
    df = spark.createDataFrame(rows, "g int, k int, claim double, seats long")
    got = {(r.g, r.k): r.won for r in mixing.sainte_lague(df, ["g"], "claim", "seats", ["k"]).collect()}
    assert got == want


def test_mix(spark, odd, empty):
    assert mixing.mix(empty).count() == 0
    out = mixing.mix(odd).collect()
    assert len(out) == odd.count() and all(0 <= r.taken <= 3 * r.size for r in out)
    assert out and sorted(map(tuple, out), key=str) == sorted(map(tuple, mixing.mix(odd.repartition(7)).collect()), key=str)
    blank = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", None, 0)], DOC)
    assert {(r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0.0, 0)}
    rng = random.Random(6)
    many = spark.createDataFrame([(k, " ".join(words(rng, 50)), "en", "abcdef"[k % 6], 0) for k in range(300)], DOC)
    sums = mixing.mix(many).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t - r.g) <= mixing.BLOCK_TOKENS for r in sums)


def test_shards(spark, odd, empty):
    assert sharding.shard_by_bytes(empty).count() == 0
    for df in (odd, odd.limit(1)):
        out = sharding.shard_by_bytes(df).collect()
        assert len(out) == df.count()
        for s, n in Counter(r.shard for r in out).items():
            assert sorted(r.slot for r in out if r.shard == s) == list(range(n))
    rng = random.Random(8)
    rows = [(k, "same text", "en", "a", 0) for k in range(9000)] + [(9000 + k, "x" * rng.randrange(200), "en", "a", 0) for k in range(3000)]
    out = sharding.shard_by_bytes(spark.createDataFrame(rows, DOC)).collect()
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.size
    target = sum(sizes.values()) / 16
    assert len(sizes) == 16 and all(abs(v - target) <= 0.02 * target + 600 for v in sizes.values())
    assert sorted((r.shard, r.slot) for r in out) == [(s, k) for s in range(16) for k in range(sum(r.shard == s for r in out))]


def test_shards_do_not_depend_on_what_counts_as_hot(spark, odd, monkeypatch):
    rows = [(k, "same text" if k % 3 == 0 else f"text {k}", "en", "a", 0) for k in range(300)]
    df = spark.createDataFrame(rows, DOC).unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars"))
    got = []
    for parts in (1, 50, 10_000):   # no group is hot, the largest ones are, all are
        monkeypatch.setattr(sharding, "HOT_PARTS", parts)
        got.append(sorted(map(str, sharding.shard_by_bytes(df).collect())))
    assert len(got[0]) == df.count() and got[0] == got[1] == got[2]


# --- 7 ---

def test_decontamination(spark, odd, empty, monkeypatch):
    rng = random.Random(12)
    items = [(k, " ".join(words(rng, rng.randrange(5, 70)))) for k in range(60)] + [(99, None), (98, ""), (97, "too short an item")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("text_key", F.lit("clash"))
    docs, want = [], set()
    for k in range(200):
        body = words(rng, rng.randrange(0, 200))
        if k % 3 == 0:
            item = rng.randrange(60)
            at = rng.randrange(len(body) + 1)
            passage = items[item][1].split()
            if k % 2:
                passage = [w.upper() + "," for w in passage]   # case and punctuation don't matter
            body[at:at] = passage
            want.add((k, item))
        docs.append((k, " ".join(body), "en", "a", 0))
    df = spark.createDataFrame(docs, DOC)

    def brute(text, item):
        a, b = (list(decontaminate.text_shingles([t]))[0].tolist() for t in (text, item))
        if not a or not b:
            return 0.0
        both = [Counter(a[i:i + len(b)]) & Counter(b) for i in range(max(1, len(a) - len(b) + 1))]
        return max(sum(c.values()) / (min(len(a), len(b)) + len(b) - sum(c.values())) for c in both)
    for block in (2000, 7):
        got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(df, bench, item_block=block).collect()}
        assert want <= set(got)
        assert all(abs(brute(docs[d][1], dict(items)[i]) - r.similarity) < 1e-9 for (d, i), r in got.items())
    monkeypatch.setattr(decontaminate, "PIECE", 64)   # long texts in overlapping pieces
    index = decontaminate.Items([i for i in items if i[0] < 60], decontaminate.RADIUS)
    assert want <= {(p, index.ids[i]) for p, i, *_ in decontaminate._hits([d[1] for d in docs], index, 0.8)}
    assert decontaminate.contaminated(odd, bench).count() == 0
    assert decontaminate.contaminated(empty, bench).count() == 0 and decontaminate.contaminated(df, bench.limit(0)).count() == 0


def test_decontamination_finds_edited_passages():
    """Recall of edited passages whose item-sized window reaches the similarity by brute force."""
    rng = random.Random(31)
    items = [(k, " ".join(words(rng, 55 if k % 2 else 150))) for k in range(120)]
    index = decontaminate.Items(items, decontaminate.RADIUS)
    docs = []
    for k, text in items:
        for kind in ("change", "insert", "delete"):
            passage = text.split()
            for _ in range(1 if k % 2 else 3):
                at = rng.randrange(len(passage))
                passage[at:at + (kind != "insert")] = ["edit"] * (kind != "delete")
            docs.append((k, " ".join(words(rng, 30) + passage + words(rng, 30))))
    reached = []
    for (k, text), s in zip(docs, decontaminate.text_shingles([t for _, t in docs]), strict=True):
        m = len(index.shingles[k])
        if max(decontaminate.similarity(s[i:i + m], index.counts[k], m) for i in range(len(s) - m + 1)) >= 0.8:
            reached.append((k, text))
    got = {(place, item) for place, item, *_ in decontaminate._hits([t for _, t in reached], index, 0.8)}
    found = Counter(k % 2 for place, (k, _) in enumerate(reached) if (place, k) in got)
    of = Counter(k % 2 for k, _ in reached)
    assert of[0] > 100 and of[1] > 100
    assert all(found[size] >= 0.96 * of[size] for size in of), (found, of)


def test_block_index_finds_all_within_radius():
    import numpy as np
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    asked = prints[rng.integers(0, 300, 2000)].copy()
    for k in range(len(asked)):
        for b in rng.choice(64, size=k % 16, replace=False):
            asked[k] ^= np.uint64(1) << np.uint64(b)
    a, c = decontaminate.BlockIndex(prints, 11).search(asked)
    far = np.bitwise_count(asked[:, None] ^ prints[None, :])
    assert {*zip(a.tolist(), c.tolist(), strict=True)} == {*zip(*(x.tolist() for x in np.nonzero(far <= 11)), strict=True)}


def test_block_index_finds_all_within_its_own_radius():
    import numpy as np
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
    asked = prints[rng.integers(0, 300, 2000)].copy()
    for k in range(len(asked)):
        for b in rng.choice(64, size=k % 20, replace=False):
            asked[k] ^= np.uint64(1) << np.uint64(b)
    a, c = decontaminate.BlockIndex(prints).search(asked)
    far = np.bitwise_count(asked[:, None] ^ prints[None, :])
    near = np.nonzero(far <= decontaminate.RADIUS)
    assert {*zip(a.tolist(), c.tolist(), strict=True)} == {*zip(*(x.tolist() for x in near), strict=True)}


# --- 8 ---

def test_style_tree(spark):
    body = "<article><h1>T &amp; x</h1><p>First  line<br>goes\non<p><b>Second</b> &lt;one&gt;<div class='share'>Share</div>" \
           "<form>f</form><section id='comments'><p>me too</p></section></article>"
    page = "<html><head><title>no</title><script>var a='<p>';</script></head><body><nav>menu</nav><!-- <p>c</p> --><div class=ad>buy</div>" \
           f"{body}<aside>side</aside><footer>f</footer>"
    want = "T & x\nFirst line goes on\nSecond <one>"
    rows = [(1, "http://h.org/1", page), (1, "http://h.org/1", page), (2, None, None), (3, "http://h.org/2", ""), (None, "http://h.org/3", "plain"),
            (4, "x", "<p>unclosed <b class='x>text"), (5, "http://h.org/5", "<div>" * 3000 + "deep"), (6, "http://h.org/6", "<main><p>m</main><p>out"),
            (7, "x", "<div id=content><p>a long text that no class marks</p></div><div class='post'>small</div>"),
            (8, "x", "<div class='post'><p>a long text that its class marks</p></div><div>other</div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("low", F.lit(1)).withColumn("host_key", F.lit(2))
    out = style_tree.extract(df).collect()
    by = {r.page_id: r.text for r in out}
    assert len(out) == len(rows) and by[1] == want and by[2] == "" and by[3] == "" and by[None] == "plain" and by[5] == "deep" and by[6] == "m"
    assert by[7] == "a long text that no class marks\nsmall" and by[8] == "a long text that its class marks"
    assert by[4].startswith("unclosed")
    assert style_tree.extract(df.limit(0)).count() == 0


def test_style_tree_removes_what_a_host_repeats(spark):
    rng = random.Random(7)
    body = [" ".join(words(rng, 30)) for _ in range(20)]
    page = "<body><div class=top><span>Site name</span></div><div class=text><p>{}</p><p>{}</p></div><div class=end>All pages say this</div>"
    rows = [(k, f"http://h.org/{k}", page.format(body[k], body[k][::-1])) for k in range(20)]
    rows += [(100 + k, f"http://few.org/{k}", page.format(body[k], body[k][::-1])) for k in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    by = {r.page_id: r.text for r in style_tree.extract(df).collect()}
    assert all(by[k] == body[k] + "\n" + body[k][::-1] for k in range(20))
    assert all("Site name" in by[100 + k] for k in range(3))   # too few pages to tell
    # copied articles keep their text, though every page of the host has it
    same = spark.createDataFrame([(k, f"http://h.org/{k}", "<body><article><p>one text</p></article>") for k in range(30)],
                                 "page_id long, url string, html string")
    assert {r.text for r in style_tree.extract(same).collect()} == {"one text"}


def test_style_tree_keeps_what_copies_repeat(spark):
    rng = random.Random(17)
    text = [" ".join(words(rng, 30)) for _ in range(3)]
    inner = "".join(f"<p>{t}</p>" for t in text)
    pages = {"copies.org": f"<body><div class=wrap><div class=text>{inner}</div></div>",   # no article
             "inner.org": f"<body><article><div class=body>{inner}</div></article>",
             "parts.org": "<body><article>" + "".join(f"<section class=c><p>{t}</p></section>" for t in text) + "</article>",
             # nearly all copies: each page has another small line
             "near.org": f"<body><div class=stamp>{{}}</div><div class=wrap><div class=text>{inner}</div></div>",
             "near-inner.org": f"<body><article><p>{{}}</p><div class=body>{inner}</div></article>"}
    rows = [(k, f"http://{h}/{k}", p.replace("{}", f"seen {k} times")) for h, p in pages.items() for k in range(12)]
    out = style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == len(rows) and all("\n".join(text) in r.text for r in out)


def test_odd_markup_takes_time_in_proportion():
    """Deep, unclosed and broken markup: eight times the page may not take anything like 64 times as long."""
    import time
    shapes = ["<div>x ", "<a ", "> <a ", "<p><b>x", "<main>x", "<main><h1>t</h1>", "<script></script ", "<a '\">x", "<!-- ", "<", "<li><ul>x"]
    ends = lambda n: "<b><div>" + "<i>" * n + "</b>" * n
    for make in [*(lambda n, s=s: s * n for s in shapes), ends]:
        took = []
        for n in (4000, 32000):
            begin = time.process_time()
            page = style_tree.Page(make(n))
            page.text(set())
            page.text({page.path[-1]})
            page.features()
            for block in page.blocks:
                page.paths(block[-1][0])
            took.append(time.process_time() - begin)
        assert took[1] < 24 * max(took[0], 0.05)
    deep = style_tree.Page("<div>x " * 20000)
    assert deep.text(set()).count("x") == 20000 and len(deep.paths(len(deep.tag) - 1)) == style_tree.MAX_PATH
    assert style_tree.Page("<p>a</p><!-- never closed <p>b</p>").text(set()) == "a"
    assert style_tree.Page("a > b <i").text(set()) == "a > b <i" and style_tree.Page("a <![CDATA[ b <p>").text(set()) == "a"


def test_importance_equals_entropies_worked_out_by_hand(spark):
    """Presentation and content of every node of a small host, from the published formulas."""
    rng = random.Random(21)
    sources = []
    for k in range(12):
        middle = f"<div class=text><p>{' '.join(words(rng, 6))}</p>" + "<p>more</p>" * (k % 3) + "</div>"
        sources.append(f"<body><div class=top><a href=/{k % 3}>Site</a></div>{middle}<div class=end>{'same' if k < 9 else k}, fixed words, {k // 2}</div></body>")
    want = {}
    pages = [style_tree.Page(s) for s in sources]
    def said(page, path):   # clauses end behind a mark before a blank
        clauses = Counter(c for block in page.blocks for k, t in block if page.path[k] == path
                          for c in " ".join(t.split()).replace(", ", ",\r").split("\r") if c)
        return Counter({c: n * len(c) for c, n in clauses.items()}) + Counter({"\n" + t: 1 + len(t) for k, t in page.links if page.path[k] == path})

    own = {p: [said(page, p) for page in pages] for page in pages for p in page.path[1:]}
    for path in own:
        styles, m, below = Counter(), 0, set()
        for page in pages:
            mine = {k for k, p in enumerate(page.path) if k and p == path}
            m += bool(mine)
            styles.update({page.style[k] for k in mine})
            below |= {page.path[k] for k, inside in enumerate(page.within(mine)) if inside}
        uses = sum(styles.values())
        looks = -sum(n / uses * math.log(n / uses) for n in styles.values()) / math.log(m)
        weight = logs = 0
        for p in below:
            for w in set().union(*own[p]):
                n = sum(c[w] for c in own[p])
                weight, logs = weight + n, logs + n * math.log(sum(w in c for c in own[p]))
        says = 1 - logs / weight / math.log(m) if weight else None
        share = style_tree.GAMMA ** len(styles)
        want[path] = (m, (1 - share) * looks + share * (1 if says is None else says), says, weight)
    texts = [w for w in want if any(own[w])]
    reference = sum(want[p][2] * want[p][3] for p in texts) / sum(want[p][3] for p in texts)
    df = spark.createDataFrame([(1, s) for s in sources], "host_key long, html string")
    got = {r.node: r for r in style_tree.importance(df).collect()}
    assert got.keys() == want.keys()
    for p, (m, value, says, _) in want.items():
        assert got[p].pages == m and abs(got[p].importance - value) < 1e-9 and abs(got[p].reference - reference) < 1e-9
        assert got[p].content is says is None or abs(got[p].content - says) < 1e-9


def test_tree_alone_removes_footers_with_a_changing_sentence(spark):
    """No name and no block tells such a footer: only its words, held against those of its host's articles."""
    rng = random.Random(23)
    some = [" ".join(words(rng, 60)) for _ in range(40)]
    page = "<body><div class=text><p>{}</p><p>{}</p></div><div class=low>All rights of h.org, the site of the town: {}</div>"
    rows = [(k, f"http://h.org/{k}", page.format(some[k], some[k][::-1], " ".join(words(rng, 2)))) for k in range(40)]
    rows += [(100 + k, f"http://few.org/{k}", page.format(some[k], some[k][::-1], "x")) for k in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for names in (True, False):
        by = {r.page_id: r.text for r in style_tree.extract(df, by_names=names).collect()}
        assert all(by[k] == some[k] + "\n" + some[k][::-1] for k in range(40))
        assert all("All rights" in by[100 + k] for k in range(3))
    # near copies without an article share their headings, which stay
    near = [(k, f"http://n.org/{k}", f"<body><h1>{some[k // 8]}</h1><p>{some[k]}</p><p>{some[k][::-1]}</p>") for k in range(40)]
    for r in style_tree.extract(spark.createDataFrame(near, "page_id long, url string, html string")).collect():
        assert r.text == "\n".join((some[r.page_id // 8], some[r.page_id], some[r.page_id][::-1]))
    # without names a menu that differs per page stays; hidden elements never show
    menu = spark.createDataFrame([(1, "http://m.org/1", "<head><title>t</title></head><nav>menu</nav><p>text</p><script>x</script>")],
                                 "page_id long, url string, html string")
    assert [r.text for r in style_tree.extract(menu, by_names=False).collect()] == ["menu\ntext"]
    assert [r.text for r in style_tree.extract(menu).collect()] == ["text"]


def test_style_tree_takes_deep_and_long_pages(spark):
    rows = [(k, "http://deep.org/x", "<div>x " * 3000 + str(k)) for k in range(12)]
    rows += [(100 + k, "http://long.org/x", "<body>" + f"<p>word{k} " * 20000 + "<a href=/z>" + "y" * 200000) for k in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("node", F.lit(1)).withColumn("content", F.lit("x"))
    by = {r.page_id: r.text for r in style_tree.extract(df).collect()}
    assert all(by[k].count("x") == 3000 for k in range(12)) and all(by[100 + k].count(f"word{k}") == 20000 for k in range(2))


def test_style_tree_weighs_articles_against_main():
    rng = random.Random(18)
    a, b = (" ".join(words(rng, 40)) for _ in range(2))
    card = "<article><p>a teaser</p></article>"
    text = lambda source: style_tree.Page(source).text(set())
    assert text(f"<body><main><h1>T</h1><p>{a}</p><p>{b}</p></main><div>{card * 3}</div>") == f"T\n{a}\n{b}"
    assert text(f"<body><main><h1>T</h1><p>{a}</p>{card}</main>") == f"T\n{a}\na teaser"
    assert text(f"<body><main><h1>T</h1><article><p>{a}</p></article><p>more</p></main>") == f"T\n{a}"
    assert text(f"<body><div><p>{a}</p></div>{card}") == f"{a}\na teaser"
    assert text(f"<body><div class=post><p>{a}</p></div>{card}") == a
    assert text(f"<body><article><p>{a}</p></article><article class=comment><p>{b}</p></article>") == a


# --- 9 ---

def _wrapped(text, before="", width=70):
    return "\n".join(before + x for x in textwrap.wrap(text, width))


def test_license_texts_and_headers(spark):
    grant, end = _wrapped(licenses._BSD_GRANT), _wrapped(licenses._BSD_END)
    owner = "Copyright (c) 1999, Some One\nAll rights reserved.\n\n"
    rows = {
        "no title": ("Copyright (c) 2020 Jane Doe\n\n" + _wrapped(licenses._MIT), "MIT"),
        "bsd 2": (owner + grant + "\n\n" + end, "BSD-2-Clause"),
        "bsd 3": (owner + grant + "\n\n" + _wrapped(licenses._BSD_NAME) + "\n\n" + end, "BSD-3-Clause"),
        "gpl header": (_wrapped(licenses._GNU.format("General Public License", 3), "# ") + "\n#\n# other words\nimport os", "GPL-3.0-or-later"),
        "gpl 2 header": (_wrapped(licenses._GNU.format("General Public License", 2), "// ") + "\nint main() {}", "GPL-2.0-or-later"),
        "lgpl header": (_wrapped(licenses._GNU.format("Lesser General Public License", 3), " * ") + "\ncode", "LGPL-3.0-or-later"),
        "apache header": (_wrapped(licenses._APACHE, " * ", 50) + "\n\nint main() {}", "Apache-2.0"),
        "apache title": ("Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/\n\nTERMS AND CONDITIONS", "Apache-2.0"),
        "two lines": ("# Licensed under the Apache\n# License, Version 2.0\ncode = 1", "Apache-2.0"),
        "mpl": ("word " * 5000 + "\nSubject to the terms of the Mozilla Public License, v. 2.0.\n" + "more " * 5000, "MPL-2.0"),
        "reserved": ("code\nAll rights reserved.\nmore", "LicenseRef-Proprietary"),
        "about": ("the license of nothing\n\nLicense", None), "deep blanks": ("\n" * 20000 + "#\n" * 20000, None),
    }
    df = spark.createDataFrame([(f"{k}/x", t, False) for k, (t, _) in rows.items()], "path string, text string, is_license_file boolean")
    got = {r.path[:-2]: r.license for r in licenses.scan(df).collect()}
    assert got == {k: want for k, (_, want) in rows.items()}


def test_license_scores_against_plain_python(spark):
    """Every unit of every file scored without bounds, the best kept."""
    texts = ["x\nReleased under the MIT License.", "# Licensed under the Apache\n# License, Version 2.0\n\ncode", _wrapped(licenses._ISC),
             "GNU General Public License, version 2 and all rights reserved; the version", "", "BY and NC under 4.0 licensed CC CC"]
    df = spark.createDataFrame(list(enumerate(texts)), "file long, text string")
    got = {r.file: (r.license, r.score) for r in licenses.notices(df).collect()}
    cut = lambda t: [x for x in re.split(licenses.SEPARATOR, t.lower()) if x]
    templates = [cut(t) for _, t in licenses.TEMPLATES]
    vocabulary = {t for v in templates for t in v}
    n = len(texts)
    idf = {t: math.log((n + 1) / (sum(t in cut(x) for x in texts) + 1)) + 1 for t in vocabulary}
    vector = lambda w: {t: (1 + math.log(w.count(t))) * idf.get(t, math.log((n + 1) / 2) + 1) for t in w}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    want = {}
    for k, text in enumerate(texts):
        lines = text.split("\n")
        stop = next((i for i, x in enumerate(lines) if not re.search(licenses.COMMENT, x)), len(lines))
        found = []
        for unit in [text, "\n".join(lines[:stop]), *re.split(licenses.BLOCK_END, text), *re.split(licenses._STATEMENT_END, text)]:
            a = vector(cut(unit))
            for (name, _), t in zip(licenses.TEMPLATES, templates, strict=True):
                b = vector(t)
                score = sum(x * b.get(y, 0) for y, x in a.items()) / (norm(a) * norm(b)) if a else 0
                if score >= licenses.THRESHOLD:
                    found.append((name in licenses.FALLBACK, -round(score, 9), name))
        if found:
            want[k] = (min(found)[2], pytest.approx(-min(found)[1], abs=2e-9))
    assert got == want


def test_licenses(spark, odd, empty):
    rows = [("a/LICENSE", "Released under the MIT License.", True), ("a/b/c/x.py", "some code", False), ("a/y.py", None, False),
            ("a/b/LICENSE", "Licensed under the Apache License, Version 2.0", True), ("z.py", "nothing", False), (None, "All rights reserved.", False),
            ("a/b/c/own.py", "code\nThis work is licensed under the GNU General Public License, version 3. more words here", False),
            ("a/b/c/x.py", "some code", False)]
    df = spark.createDataFrame(rows, "path string, text string, is_license_file boolean").withColumn("dir", F.lit("clash"))
    got = Counter((r.path, r.license, r.origin, r.inherited_from) for r in licenses.scan(df).collect())
    assert got == Counter({("a/LICENSE", "MIT", "notice", None): 1, ("a/b/c/x.py", "Apache-2.0", "directory", "a/b"): 2,
                           ("a/y.py", "MIT", "directory", "a"): 1, ("a/b/LICENSE", "Apache-2.0", "notice", None): 1,
                           ("z.py", None, "none", None): 1, (None, "LicenseRef-Proprietary", "notice", None): 1,
                           ("a/b/c/own.py", "GPL-3.0-only", "notice", None): 1})
    assert licenses.scan(licenses.files_of_documents(empty)).count() == 0
    assert licenses.scan(licenses.files_of_documents(odd)).count() == odd.count()


def test_sha_of_kept_lines(spark):
    df = spark.createDataFrame([(1, "é\r\nx", None, None, None)], DOC)
    r = line_dedup.dedup_lines(df).select(F.sha2("kept", 256).alias("s")).head()
    assert r.s == hashlib.sha256("é\r\nx".encode()).hexdigest()
