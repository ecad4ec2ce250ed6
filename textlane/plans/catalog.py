"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver's whole tables and runs one operator (or a
composed stage) of the library.  Floating outputs are rounded to 6 digits so
that an independent engine can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlane.functions.expr import plus_concat, tokens as token_expr, unit_hash
from textlane.functions.stem import stem_table
from textlane.functions.stopwords import ENGLISH_STOPWORDS
from textlane.operators import clean, features as feat, metrics as met, models, runs, sampling, text
from textlane.session import fresh_path, materialize, table
from textlane.sources import files

SPLIT_SEED, TEST_SIZE = 42, 0.3
PROBA_DIGITS = 9


def _r(c, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits)


# shared stages -------------------------------------------------------------

def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def docs_by_id(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """Documents hash-partitioned by ``doc_id``.

    Texts are few rows with a lot of bytes each; spreading them by id gives
    the tokenizer parallel tasks, and because every later per-document step
    (term counts, the L2 norm) is clustered by ``doc_id``, this one shuffle of
    raw text replaces the shuffles of the (much longer) token stream.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return docs(spark, d).select("doc_id", *cols).repartition(n, "doc_id")


def clean_tokens(spark: SparkSession, d: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *keep, pos, term)`` after tokenizing and English stop-word removal."""
    t = text.remove_stopwords(text.tokenize(docs_by_id(spark, d, *keep, "text")))
    return text.explode_tokens(t, "doc_id", "tokens", keep)


_materialize = materialize


def tfidf_features(spark: SparkSession, d: str, materialize: bool = False):
    """(features ``(doc_id, term, tf, w)``, vocabulary, n_docs, vocab size) over all documents.

    With ``materialize`` the TF-IDF table is written once to the shared
    checkpoint folder (it feeds both fitting and scoring, and the tokenizer
    is the costly part), and so is the vocabulary: its size is asked for by
    every model, and each time all counts would be grouped again.
    """
    tf = feat.term_counts(clean_tokens(spark, d))
    if materialize:
        tf = _materialize(tf, "tf")    # tokenize once: read by the vocabulary and by the weights
    vocab = feat.vocabulary(tf)
    if materialize:
        vocab = _materialize(vocab, "vocabulary")
    n = feat.doc_count(docs(spark, d))
    x = feat.tfidf(tf, feat.with_idf(vocab, n))
    if materialize:
        x = _materialize(x, "tfidf")
    return x, vocab, n, vocab.select(F.count(F.lit(1))).scalar()


def count_features(spark: SparkSession, d: str):
    """(counts ``(doc_id, term, tf)``, vocabulary with idf, its size): the TF-IDF rows of all documents in parts, both written.

    Counts are written by term, not by document: they are shuffled by term, and equal neighbours compress well.
    """
    tf = _materialize(feat.term_counts(clean_tokens(spark, d)).sortWithinPartitions("term", "doc_id"), "tf")
    idf = _materialize(feat.with_idf(feat.vocabulary(tf), feat.doc_count(docs(spark, d))), "vocabulary")
    return tf, idf, idf.select(F.count(F.lit(1))).scalar()


def lang_split(spark: SparkSession, d: str) -> DataFrame:
    return sampling.split_by_hash(docs(spark, d).select("doc_id", F.col("lang").alias("y")),
                                  "doc_id", TEST_SIZE, SPLIT_SEED)


def quality_split(spark: SparkSession, d: str) -> DataFrame:
    lab = table(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("y"))
    return sampling.split_by_hash(lab, "doc_id", TEST_SIZE, SPLIT_SEED)


def nb_predictions(spark: SparkSession, d: str, split: DataFrame, alpha: float = 1.0):
    """Fit NB on the train rows of ``split`` and score all its rows: (pred, proba long)."""
    tf, idf, v = count_features(spark, d)
    train = split.filter(F.col("split") == "train").select("doc_id", F.col("y").alias("label"))
    model = models.naive_bayes_from_sums(models.class_sums(tf, idf, train), train, v, alpha)
    pr = models.predict_from_counts(tf, idf, split.select("doc_id"), model, digits=PROBA_DIGITS)
    # one row per document, read by every metric: score once
    pred = _materialize(pr.join(split, "doc_id").select("doc_id", "split", "y", "p", "proba"), "nb-pred")
    proba = pred.select("doc_id", "split", "y", F.explode("proba").alias("_e")).select(
        "doc_id", "split", "y", F.col("_e.label").alias("label"), F.col("_e.prob").alias("prob"))
    return pred.drop("proba"), proba


# flagship ------------------------------------------------------------------

def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Language classification: tokens -> stop words -> TF-IDF -> NB -> weighted P/R/F1 per split."""
    pred, _ = nb_predictions(spark, d, lang_split(spark, d))
    w = met.weighted_prf(pred, by=("split",))
    a = met.accuracy(pred, by=("split",))
    return a.join(w, "split").select("split", _r("accuracy").alias("accuracy"), _r("precision").alias("precision"),
                                     _r("recall").alias("recall"), _r("f1").alias("f1"), "n")


# sources -------------------------------------------------------------------

def s1_json_flatten(spark, d):
    ev = table(spark, d, "events").select("event_id", "props")
    return files.parse_json_column(ev, "props", "k bigint", sep="_")


def s2_csv_roundtrip(spark, d):
    path = fresh_path(spark, "csv")
    src = docs(spark, d).select("doc_id", "lang", "source", "n_chars", "text")
    files.write_csv(src, path)
    back = files.read_csv(spark, path, "doc_id bigint, lang string, source string, n_chars bigint, text string")
    return back.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("sum_n_chars"),
                                    F.sum(F.length("text")).alias("sum_length"))


def s5_label_map(spark, d):
    path = fresh_path(spark, "labelmap")
    m = feat.label_map_from_pairs(table(spark, d, "region"), "r_regionkey", "r_name")
    files.write_label_map(m, path)
    return files.read_label_map(spark, path)


def s6_snapshot_roundtrip(spark, d):
    path = fresh_path(spark, "snapshot")
    files.write_snapshot(lang_split(spark, d), path, ("split",))
    back = files.read_snapshot(spark, path).filter(F.col("split") == "test")   # partition pruning
    return back.groupBy(F.col("y").alias("lang")).agg(F.count(F.lit(1)).alias("n_test"))


def s10_runstore_scan(spark, d):
    """Write events as a file-per-metric run store, scan it back, summarise per run and key."""
    root = fresh_path(spark, "runstore")
    ev = table(spark, d, "events")
    lines = ev.select(F.lit("0").alias("exp"), F.col("user_id").cast("string").alias("run"),
                      F.col("event_type").alias("key"),
                      F.concat_ws(" ", F.unix_millis(F.col("ts").cast("timestamp")).cast("string"),
                                  F.col("value").cast("string"), F.col("event_id").cast("string")).alias("line"))
    files.write_file_per_group(lines, root, ("exp", "run", "key"))
    m = files.scan_run_metrics(spark, root, r"/exp=([^/]+)/run=([^/]+)/key=([^/]+)/[^/]+$")
    return m.groupBy(F.col("run_id").cast("bigint").alias("user_id"), "key").agg(
        F.count(F.lit(1)).alias("n_values"), _r(F.max_by("value", F.struct("ts_ms", "step"))).alias("last_value"),
        F.max("step").alias("max_step"))


# cleaning --------------------------------------------------------------------

def _tickets(spark, d):
    raw = docs(spark, d).select("doc_id", "text", "source", F.nullif(F.col("lang"), F.lit("es")).alias("sub"))
    return clean.build_tickets(raw, "text", "source", "sub", keep=("doc_id",))


def p_clean(spark, d):
    t = _tickets(spark, d)
    return t.select("doc_id", F.md5("complaint_what_happened").alias("complaint_md5"), "ticket_classification")


def p7_dense_index(spark, d):
    t = _tickets(spark, d).select("doc_id")
    out = clean.dense_index(t, "doc_id", "ticket_index")
    return out.select("doc_id", "ticket_index", F.concat(F.lit("ticket_"), F.col("ticket_index")).alias("ticket_name"))


def p8_shape(spark, d):
    return clean.shape(docs(spark, d))


def p9_value_counts(spark, d):
    return clean.value_counts(docs(spark, d), "lang")


def p10_sample_n(spark, d):
    return clean.sample_n(docs(spark, d).select("doc_id", "lang", "n_chars"), "doc_id", 5, seed=SPLIT_SEED)


def p11_head(spark, d):
    return clean.head(docs(spark, d).select("doc_id", "lang", "source"), "doc_id", 5)


def p12_distinct(spark, d):
    return clean.distinct_values(docs(spark, d), "source")


def _masked(c: Column) -> Column:
    """Put redaction marks into real text: a date-like mask in front, every 'a' as 'xxxx'."""
    return F.concat(F.lit("xx/xx/2019 "), F.regexp_replace(c, "a", "xxxx"), F.lit(" box/y xxxxx"))


def p13_mask_strip(spark, d):
    out = clean.strip_masks(_masked(F.col("text")))
    return docs(spark, d).select("doc_id", F.length(out).alias("n_chars_out"), F.md5(out).alias("text_md5"))


def p15_bround(spark, d):
    x = (F.col("event_id") % 1000) / F.lit(8.0)
    return table(spark, d, "events").select("event_id", x.alias("x"), F.bround(x, 2).alias("half_even"),
                                            F.round(x, 2).alias("half_up"))


# text --------------------------------------------------------------------

def t2_tokens(spark, d):
    t = text.explode_tokens(text.tokenize(docs_by_id(spark, d, "lang", "text")), keep=("lang",))
    return t.groupBy("lang").agg(F.count(F.lit(1)).alias("n_tokens"), F.countDistinct("term").alias("n_terms"))


def t3_stopwords(spark, d):
    t = clean_tokens(spark, d, keep=("lang",))
    return t.groupBy("lang").agg(F.count(F.lit(1)).alias("n_tokens"), F.countDistinct("term").alias("n_terms"))


def t4_stem(spark, d):
    vocab = clean_tokens(spark, d).select("term").distinct()
    return stem_table(vocab)


def processed_long(spark, d, keep: tuple[str, ...] = ()) -> DataFrame:
    """T2-T5 on all documents: ``(doc_id, *keep, pos, term)`` of kept, stemmed nouns."""
    from textlane.operators.text_chain import stem_and_tag
    return stem_and_tag(clean_tokens(spark, d, keep))


def t5_noun_filter(spark, d):
    from textlane.operators.text_chain import tag_tokens
    t = tag_tokens(clean_tokens(spark, d, keep=("lang",)))
    return t.groupBy("lang", "tag").agg(F.count(F.lit(1)).alias("n_tokens"))


def t7_processed_text(spark, d):
    from textlane.operators.text_chain import processed_text
    out = processed_text(docs(spark, d))
    return out.select("doc_id", F.md5("processed_text").alias("text_md5"),
                      F.length("processed_text").alias("n_chars"))


def t8_pipeline_clean(spark, d):
    from textlane.operators.text_chain import build_processed
    raw = docs(spark, d).select(
        "doc_id", "text", "source", F.nullif(F.col("lang"), F.lit("es")).alias("sub"))
    out = build_processed(raw, "text", "source", "sub", keep=("doc_id",))
    return out.select("doc_id", "ticket_classification", F.md5("processed_text").alias("text_md5"))


# features ----------------------------------------------------------------

def f1_term_counts(spark, d):
    return feat.vocabulary(feat.term_counts(clean_tokens(spark, d)))


def f2_tfidf(spark, d):
    x, _, _, _ = tfidf_features(spark, d)
    return x.select("doc_id", "term", "tf", _r("w").alias("w"))


def bounded_tfidf(spark, d, min_df=2, max_df=0.95, materialize: bool = False):
    tf = feat.term_counts(clean_tokens(spark, d))
    if materialize:
        # tokenize once: read by the vocabulary and by the weights; by term, so that equal neighbours compress
        tf = _materialize(tf.sortWithinPartitions("term", "doc_id"), "tf")
    n = feat.doc_count(docs(spark, d))
    vocab = feat.bounded_vocabulary(feat.vocabulary(tf), n, min_df, max_df)
    return feat.tfidf(tf, feat.with_idf(vocab, n)), vocab


def f3_tfidf_bounded(spark, d):
    x, _ = bounded_tfidf(spark, d)
    return x.select("doc_id", "term", "tf", _r("w").alias("w"))


def f4_vocab_size(spark, d):
    _, vocab = bounded_tfidf(spark, d)
    return feat.vocab_size(vocab)


def f6_top_words(spark, d):
    from textlane.operators.topics import top_terms
    x, _, _, _ = tfidf_features(spark, d)
    lang = docs(spark, d).select("doc_id", "lang")
    sums = (x.join(lang, "doc_id").groupBy("lang", "term").agg(F.round(F.sum("w"), 9).alias("weight")))
    return top_terms(sums, "lang", "term", "weight", 15).select("lang", "rank", "term", "weight")


def f9_string_argmax(spark, d):
    t = _tickets(spark, d).select("doc_id", "complaint_what_happened", "ticket_classification",
                                  F.col("doc_id").cast("string").alias("doc_key"))
    return t.select("doc_id", feat.string_argmax("complaint_what_happened", "ticket_classification",
                                                 "doc_key").alias("relevant_topics"))


def f10_label_decode(spark, d):
    m = feat.label_map_from_pairs(table(spark, d, "region"), "r_regionkey", "r_name")
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    return feat.decode_labels(n, "n_regionkey", m, "region_label")


def f11_label_encode(spark, d):
    dd = docs(spark, d).select("doc_id", "lang")
    m = feat.ordinal_label_map(dd, "lang")
    return feat.encode_labels(dd, "lang", m, "lang_idx").select("doc_id", "lang", F.col("lang_idx").cast("int").alias("lang_idx"))


# models ------------------------------------------------------------------

def m1_nb_fit(spark, d):
    tf, idf, v = count_features(spark, d)
    train = lang_split(spark, d).filter(F.col("split") == "train").select("doc_id", F.col("y").alias("label"))
    model = models.naive_bayes_from_sums(models.class_sums(tf, idf, train), train, v)
    return model.terms.join(model.classes.select("label", "log_prior"), "label").select(
        "label", "term", _r("log_theta").alias("log_theta"), _r("log_prior").alias("log_prior"))


def m2_nb_predict(spark, d):
    pred, _ = nb_predictions(spark, d, lang_split(spark, d))
    return pred.select("doc_id", "split", "y", "p")


def m2_nb_proba(spark, d):
    _, proba = nb_predictions(spark, d, quality_split(spark, d))
    return proba.select("doc_id", "label", _r("prob").alias("prob"))


def m9_batch_score(spark, d):
    """Fit, save the model tables, load them back and score the test rows."""
    tf, idf, v = count_features(spark, d)
    sp = lang_split(spark, d)
    train = sp.filter(F.col("split") == "train").select("doc_id", F.col("y").alias("label"))
    model = models.naive_bayes_from_sums(models.class_sums(tf, idf, train), train, v)
    path = fresh_path(spark, "nbmodel")
    model.write(path)
    loaded = models.NaiveBayesModel.load(spark, path)
    test = sp.filter(F.col("split") == "test")
    return models.predict_from_counts(tf, idf, test.select("doc_id"), loaded).select("doc_id", "p")


# metrics -----------------------------------------------------------------

def _qpred(spark, d):
    return nb_predictions(spark, d, quality_split(spark, d))


def e1_accuracy(spark, d):
    pred, _ = _qpred(spark, d)
    return met.accuracy(pred, by=("split",)).select("split", _r("accuracy").alias("accuracy"))


def e2_prf_weighted(spark, d):
    pred, _ = _qpred(spark, d)
    w = met.weighted_prf(pred, by=("split",))
    return w.select("split", _r("precision").alias("precision"), _r("recall").alias("recall"),
                    _r("f1").alias("f1"), "n")


def e3_f1_micro_macro(spark, d):
    pred, _ = _qpred(spark, d)
    return met.f1_micro_macro(pred, by=("split",)).select("split", _r("f1_micro").alias("f1_micro"),
                                                         _r("f1_macro").alias("f1_macro"))


def e4_auc_ovr(spark, d):
    _, proba = _qpred(spark, d)
    return met.auc_ovr(proba, by=("split",)).select("split", _r("auc").alias("auc"))


def e5_confusion(spark, d):
    pred, _ = nb_predictions(spark, d, lang_split(spark, d))
    return met.confusion_matrix(pred, by=("split",))


def e6_report(spark, d):
    pred, _ = _qpred(spark, d)
    r = met.classification_report(pred, by=("split",))
    return r.select("split", "row", _r("precision").alias("precision"), _r("recall").alias("recall"),
                    _r("f1").alias("f1"), "support")


def e7_train_test(spark, d):
    pred, proba = _qpred(spark, d)
    t = met.train_test_table(pred, proba)
    return t.select("metric", "split", _r("value").alias("value"))


def e8_production_eval(spark, d):
    pred = m9_batch_score(spark, d)
    y = lang_split(spark, d).select("doc_id", "y")
    return met.accuracy(pred.join(y, "doc_id")).select(_r("accuracy").alias("accuracy"))


# sampling ----------------------------------------------------------------

def g1_split(spark, d):
    return lang_split(spark, d).groupBy("split", F.col("y").alias("lang")).agg(F.count(F.lit(1)).alias("n"))


def g1_split_exact(spark, d):
    s = sampling.split_exact(docs(spark, d).select("doc_id"), "doc_id", TEST_SIZE, SPLIT_SEED)
    return s.filter(F.col("split") == "test").select("doc_id")


def g2_folds(spark, d):
    return sampling.stratified_folds(docs(spark, d).select("doc_id", "lang"), "doc_id", "lang", 5, 37)


def g4_class_weight(spark, d):
    return sampling.class_weights(docs(spark, d), "lang").select("lang", "n_c", _r("weight").alias("weight"))


# runs ----------------------------------------------------------------------

def _events(spark, d):
    return table(spark, d, "events")


def r1_runs_wide(spark, d):
    w = runs.runs_wide(_events(spark, d), "user_id", "event_type", "value", ["ts", "event_id"])
    return w


def _purchase_last(spark, d):
    last = runs.last_values(_events(spark, d), "user_id", "event_type", "value", ["ts", "event_id"])
    return last.filter(F.col("event_type") == "purchase").select("user_id", F.col("value").alias("purchase"))


def r3_search_filter(spark, d):
    ev = _events(spark, d)
    all_runs = _purchase_last(spark, d)
    tagged = ev.filter((F.col("event_type") == "signup") & (F.col("value") > 50)).select("user_id")
    deleted = ev.filter((F.col("event_type") == "error") & (F.col("value") > 95)).select("user_id")
    return runs.search_runs(all_runs, "user_id", F.col("purchase") > 10, tagged, deleted)


def r4_top_runs(spark, d):
    return runs.top_runs(_purchase_last(spark, d), "purchase", "user_id", 4)


def _versions(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("name"), "o_orderkey", "o_orderdate",
                                         F.col("o_orderstatus").alias("stage"))
    o = o.withColumn("_day", F.to_date("o_orderdate"))
    return runs.register_versions(o, "name", ["o_orderdate", "o_orderkey"], "_day").drop("_day")


def r5_versions(spark, d):
    return _versions(spark, d).select("name", "o_orderkey", "version")


def r6_latest_versions(spark, d):
    return runs.latest_versions(_versions(spark, d), "name", "stage")


def r7_stage_state(spark, d):
    return runs.stage_with_archiving(_versions(spark, d), "name", "stage").select("name", "version", "current_stage")


def r7_no_archive(spark, d):
    return _versions(spark, d).select("name", "version", F.col("stage").alias("current_stage"))


def r8_run_duration(spark, d):
    return runs.run_durations(_events(spark, d), "user_id", "ts")


# topics --------------------------------------------------------------------

def _nmf_one_step(spark, d, k: int = 4, seed: int = 123):
    from textlane.operators import topics
    x, _ = bounded_tfidf(spark, d, materialize=True)
    # X is read by both start factors and both half steps: cut it once, by term as well
    X = _materialize(x.select("doc_id", "term", F.col("w").alias("x")).sortWithinPartitions("term", "doc_id"), "nmf-x")
    s = topics.nmf_init(X, k, seed)
    H = topics.update_h(X, s, k).checkpoint()
    return topics.NMFState(topics.update_w(X, topics.NMFState(s.W, H), k), H)


def f5_nmf_step(spark, d):
    from textlane.operators import topics
    W = topics.long_factor(_nmf_one_step(spark, d).W, "doc_id", "w")
    return W.select("doc_id", F.col("topic").cast("int").alias("topic"), _r("w").alias("w"))


def f7_doc_topic(spark, d):
    from textlane.operators import topics
    return topics.doc_topic_table(_nmf_one_step(spark, d).W, 4)


def f8_dominant_topic(spark, d):
    from textlane.operators import topics
    return topics.dominant_topic(_nmf_one_step(spark, d).W)


def r1_stream_latest(spark, d):
    """Latest value per (run, metric) computed by a streaming aggregation over the events files."""
    from textlane.streaming.runs import latest_values_stream, metric_stream, run_available
    schema = table(spark, d, "events").schema
    stream = metric_stream(spark, d, schema, file_glob="events.parquet")
    agg = latest_values_stream(stream, "user_id", "event_type", "value", ["ts", "event_id"])
    out = run_available(agg, fresh_path(spark, "stream-out"))
    return spark.read.parquet(out)
