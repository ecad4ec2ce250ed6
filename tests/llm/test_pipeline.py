"""The pipeline against a brute-force version, stage by stage, and its handling of odd rows."""

import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import DOC, brute_classes, near_copies, words
from textlane.llm import mixing, quality_lines, sharding
from textlane.llm.common import hashed_words


def corpus():
    rng = random.Random(21)
    texts = near_copies(22, groups=15, size=3)
    texts += [" ".join(words(rng, 80)) for _ in range(60)] + ["too short", "", None, " ".join(words(rng, 10) * 9)]
    items = [(k, " ".join(words(rng, 30))) for k in range(10)]
    texts += [" ".join(words(rng, 30) + items[k][1].split() + words(rng, 30)) for k in range(5)]
    texts += [texts[0], texts[20]]
    rows = [(k, t, "en", "abcd"[k % 4], len(t or "")) for k, t in enumerate(texts)]
    return rows + [rows[3]], items


def test_stages_against_brute_force(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, DOC).withColumn("shard", F.lit("extra")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = rows
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, columns = kept, docs.columns
        docs = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert docs.columns == columns
            docs.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            kept = [tuple(r)[:5] for r in docs.collect()]
        if k == 0:
            def good(t):
                raw = (t or "").encode()
                n, *_, repeated = quality_lines.text_metrics(t or "", raw, next(hashed_words([raw])))
                return n >= 20 and 100 * repeated <= 30 * n
            assert Counter(kept) == Counter(r for r in before if good(r[1]))   # no line here is common
        elif k == 1:
            before = sorted(set(before))
            roots, _ = brute_classes([r[1] for r in before])
            assert Counter(kept) == Counter(r for i, r in enumerate(before) if roots[i] == i)
        elif k == 2:
            assert Counter(kept) == Counter(r for r in before if not any(t in r[1] for _, t in items))
        elif k == 3:
            taken = {r.doc_id: r for r in mixing.mix(spark.createDataFrame(before, DOC)).collect()}
            want = {d: int(r.taken / r.size + 0.5) for d, r in taken.items()}
            assert Counter(r[0] for r in kept) == Counter({d: n for d, n in want.items() if n})
    out = docs.collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in kept)
    assert all(r.law == "bytes" and 0 <= r.shard < sharding.SHARDS for r in out)
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(run) == Counter(out)


def test_stages_take_odd_rows(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    long = " ".join(words(random.Random(1), 500))
    rows = [(None, None, None, None, None), (1, "", "en", "", 0), (1, long, "en", "a", 1), (1, long, "en", "a", 1), (None, long + " z", None, None, 1)]
    for some in (spark.createDataFrame(rows, DOC), spark.createDataFrame([], DOC)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, some, str(tmp_path)).count() >= 0
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, DOC), str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.text is None or r.text == "") for r in kept) == [("1", False), ("1", True), ("None", True)]
