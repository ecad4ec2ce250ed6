"""Plan checks: tokenizer runs once per row, no Python in the text/metric plans."""

from pyspark.sql import functions as F

from tests.conftest import SF
from textlane.operators import features as feat, text


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _filters(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if line.strip().lstrip("+-: *()0-9").startswith("Filter")]


def test_tokenizer_not_duplicated_into_filter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(4, "doc_id")
    tf = feat.term_counts(text.explode_tokens(text.remove_stopwords(text.tokenize(docs))))
    plan = _plan(tf)
    # one tokenizer in the projection, none in an inferred filter under the generator
    assert plan.count("regexp_extract_all") == 1
    assert not any("regexp_extract_all" in f for f in _filters(plan))


def test_no_python_udf_in_text_and_metric_plans(spark):
    from textlane.plans import catalog
    for name in ("t3_stopwords", "t4_stem", "f2_tfidf", "e7_train_test", "flagship"):
        plan = _plan(getattr(catalog, name)(spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_term_counts_need_no_shuffle_after_doc_partitioning(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(4, "doc_id")
    tf = feat.term_counts(text.explode_tokens(text.tokenize(docs)))
    # the only exchange is the one that spreads raw documents by id
    assert _plan(tf).count("Exchange hashpartitioning") == 1


def test_tfidf_same_under_partition_counts(spark):
    from textlane.plans import catalog
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in ("1", "4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            x, _, _, _ = catalog.tfidf_features(spark, SF)
            got.append(sorted((r.doc_id, r.term, r.tf, round(r.w, 9)) for r in x.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1] == got[2] and got[0]


def test_topic_step_writes_its_tables_by_term(spark, monkeypatch):
    from tests.conftest import SF
    from textlane.plans import catalog
    plans, write = {}, catalog._materialize

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
        return write(df, name)

    monkeypatch.setattr(catalog, "_materialize", noted)
    catalog._nmf_one_step(spark, SF)
    assert all(plans[name].startswith("Sort [term#") and plans[name].endswith(", false") for name in ("tf", "nmf-x")), plans
