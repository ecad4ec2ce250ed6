"""Registered queries that pass through files: nested JSON, stop-word folders, run log, saved models, model registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlane.operators import clean, features as feat, metrics as met, mllib, models, runs, sampling, sentences, tagger, text
from textlane.plans.catalog import (SPLIT_SEED, TEST_SIZE, _events, _r, clean_tokens, count_features, docs, docs_by_id,
                                    flagship, lang_split)
from textlane.session import fresh_path, materialize
from textlane.sources import files

#: A term in at least this share of a language's documents is a stop word of that language.
STOP_SHARE = 0.5
#: Registered models of e8_registry_eval, as version: alpha, stage.
REGISTERED = {1: (0.1, "Staging"), 2: (1.0, "production"), 3: (0.01, "None")}


def s1_json_scan(spark: SparkSession, d: str) -> DataFrame:
    """Documents written as nested JSON records, scanned back with a schema, flattened and made into tickets."""
    path = fresh_path(spark, "json")
    docs(spark, d).select(F.col("doc_id").alias("_id"), F.struct(
        F.col("text").alias("complaint_what_happened"), F.col("source").alias("product"),
        F.struct(F.nullif("lang", F.lit("es")).alias("name")).alias("sub")).alias("_source")).write.json(path)
    raw = files.read_json(spark, path, "_id bigint, _source struct<complaint_what_happened string, product string, "
                                       "sub struct<name string>>", sep="_")
    t = clean.build_tickets(raw, "_source_complaint_what_happened", "_source_product", "_source_sub_name", keep=("_id",))
    return t.select(F.col("_id").alias("doc_id"), F.md5("complaint_what_happened").alias("complaint_md5"),
                    "ticket_classification")


def s6_model_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """TF-IDF vector model saved, loaded and applied: terms and sum of weights of every document.

    Up to ``MAX_VECTOR_TERMS`` terms the model is a vector; beyond, a table, applied by joins.
    """
    toks = text.remove_stopwords(text.tokenize(docs_by_id(spark, d, "text")))
    tf = materialize(feat.term_counts(text.explode_tokens(toks)), "tf")
    vocab = materialize(feat.with_idf(feat.vocabulary(tf), feat.doc_count(docs(spark, d))), "vocabulary")
    path = files.versioned_path(fresh_path(spark, "vectorizer"), "tfidf", 1)
    if vocab.count() > mllib.MAX_VECTOR_TERMS:
        mllib.TableVectorizer(vocab).save(path)
        rows = materialize(toks.select(F.monotonically_increasing_id().alias("row"), "doc_id", "tokens"), "tokens")
        x = mllib.TableVectorizer.load(spark, path).transform(rows, "row")
        sums = x.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"))
        out = rows.select("row", "doc_id").join(sums, "row", "left")
        return out.select("doc_id", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_terms"),
                          _r(F.coalesce("w", F.lit(0.0))).alias("w_sum"))
    mllib.save_model(mllib.tfidf_vectorizer(vocab), path)
    rows = fresh_path(spark, "vectors")
    mllib.load_model(path).transform(toks).select("doc_id", "features").write.parquet(rows)
    # Read as what a vector is in the file, so that a sparse one is never spread over the whole vocabulary.
    out = spark.read.schema("doc_id bigint, features struct<indices array<int>, values array<double>>").parquet(rows)
    return out.select("doc_id", F.size("features.values").cast("bigint").alias("n_terms"),
                      _r(F.aggregate("features.values", F.lit(0.0), lambda a, x: a + x)).alias("w_sum"))


def s11_run_log(spark: SparkSession, d: str) -> DataFrame:
    """Parameters, metrics and tags of the flagship run appended to the run table by three writes, read back."""
    path = fresh_path(spark, "runlog")
    result = materialize(flagship(spark, d), "flagship")
    names = ["accuracy", "precision", "recall", "f1"]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names]))
    metrics = result.select("split", pairs.alias("m")).select(
        F.lit("flagship").alias("run_id"), F.lit("metric").alias("kind"), F.concat_ws("_", "split", "m.name").alias("key"),
        F.col("m.value").cast("string").alias("value"))
    size = result.select(F.sum("n").alias("n"))
    params = size.select(F.lit("flagship").alias("run_id"), F.lit("param").alias("kind"), F.explode(F.create_map(
        F.lit("alpha"), F.lit("1.0"), F.lit("seed"), F.lit(str(SPLIT_SEED)), F.lit("test_size"), F.lit(str(TEST_SIZE)),
        F.lit("n_docs"), F.col("n").cast("string"))).alias("key", "value"))
    tags = size.select(F.lit("flagship").alias("run_id"), F.lit("tag").alias("kind"), F.lit("model").alias("key"),
                       F.lit("MultinomialNB").alias("value"))
    for rows in (params, metrics, tags):
        files.append_run_values(rows, path)
    log = spark.read.parquet(path)
    number = F.when(F.col("kind") == "metric", F.col("value").cast("double"))
    return log.select("run_id", "kind", "key", _r(number).alias("metric"),
                      F.when(F.col("kind") != "metric", F.col("value")).alias("setting"))


def t2_treebank(spark: SparkSession, d: str) -> DataFrame:
    """Tokens with punctuation and contractions apart, counted per language."""
    t = text.explode_tokens(text.tokenize(docs_by_id(spark, d, "lang", "text"), mode="treebank"), keep=("lang",))
    return t.groupBy("lang").agg(F.count(F.lit(1)).alias("n_tokens"), F.countDistinct("term").alias("n_terms"))


def t3_stopword_dir(spark: SparkSession, d: str) -> DataFrame:
    """Stop words per language: those of half the language's documents, written as one folder per language, read, removed."""
    tf = materialize(feat.term_counts(text.explode_tokens(text.tokenize(docs_by_id(spark, d, "lang", "text")), keep=("lang",)),
                                      keep=("lang",)), "lang-tf")
    size = docs(spark, d).groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
    common = (tf.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("df")).join(size, "lang")
              .filter(F.col("df") >= STOP_SHARE * F.col("n_docs")))
    path = fresh_path(spark, "stopwords")
    common.select("lang", "term").write.partitionBy("lang").text(path)
    stop = files.read_stopword_dir(spark, path, r"/lang=([^/]+)/[^/]+$")
    left = text.remove_stopwords_table(tf, stop, "lang")
    return left.groupBy("lang").agg(F.sum("tf").alias("n_tokens"), F.countDistinct("term").alias("n_terms"))


def t5_lexicon_tags(spark: SparkSession, d: str) -> DataFrame:
    """Tags from a lexicon where it has the term, else by word shape; the lexicon calls the benchmark's terms ``BENCH``."""
    from textlane.operators.text_chain import tag_tokens
    from textlane.session import table
    lexicon = text.explode_tokens(text.tokenize(table(spark, d, "benchmark").select("item_id", "text")), "item_id")
    lexicon = lexicon.select("term").distinct().withColumn("tag", F.lit("BENCH"))
    tf = feat.term_counts(clean_tokens(spark, d, keep=("lang",)), keep=("lang",))
    return tag_tokens(tf, lexicon).groupBy("lang", "tag").agg(F.sum("tf").alias("n_tokens"))


def f2_tfidf_train(spark: SparkSession, d: str) -> DataFrame:
    """TF-IDF of all documents with the vocabulary and idf of the training rows only."""
    x, _ = train_tfidf(spark, d)
    return x.select("doc_id", "split", "term", "tf", _r("w").alias("w"))


def train_tfidf(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(features with split, vocabulary): fitted on train rows; terms that only test rows have are dropped."""
    split = lang_split(spark, d).select("doc_id", "split")
    tf = materialize(feat.term_counts(clean_tokens(spark, d)), "tf")
    train = split.filter(F.col("split") == "train")
    vocab = feat.vocabulary(tf.join(train, "doc_id", "left_semi"))
    x = feat.tfidf(tf, feat.with_idf(vocab, feat.doc_count(train)))
    return x.join(split, "doc_id"), vocab


def e8_registry_eval(spark: SparkSession, d: str) -> DataFrame:
    """Three models registered with a stage each; the latest in production (whatever its case) is loaded and evaluated."""
    tf, idf, v = count_features(spark, d)
    split = materialize(lang_split(spark, d), "split")
    train = split.filter(F.col("split") == "train").select("doc_id", F.col("y").alias("label"))
    sums = models.class_sums(tf, idf, train)     # the same for every alpha
    base = fresh_path(spark, "registry")
    for version, (alpha, _) in REGISTERED.items():
        models.naive_bayes_from_sums(sums, train, v, alpha).write(files.versioned_path(base, "nb", version))
    log = spark.createDataFrame([("nb", k, stage) for k, (_, stage) in REGISTERED.items()], "name string, version int, stage string")
    latest = runs.latest_versions(log.withColumn("stage", F.lower("stage")), "name", "stage")
    chosen = latest.filter(F.col("stage") == "production").first()   # one row per model and stage
    model = models.NaiveBayesModel.load(spark, files.versioned_path(base, chosen["name"], chosen["latest_version"]))
    test = split.filter(F.col("split") == "test")
    pred = models.predict_from_counts(tf, idf, test.select("doc_id"), model).select("doc_id", "p").join(test, "doc_id")
    return met.accuracy(pred).select(F.lit(chosen["latest_version"]).alias("version"), _r("accuracy").alias("accuracy"))


def r8_run_status(spark: SparkSession, d: str) -> DataFrame:
    """Status of every run (user): failed if its last event is an error, finished if it is a purchase, else running."""
    return runs.run_status(_events(spark, d), "user_id", "event_type", ["ts", "event_id"], finished=("purchase",), failed=("error",))


def t2_abbreviations(spark: SparkSession, d: str) -> DataFrame:
    """Word types that the corpus shows to be abbreviations, by language."""
    scores = sentences.type_scores(docs(spark, d)).filter(F.round("score", 9) >= sentences.MIN_SCORE)
    return scores.select("lang", "type", "n", "n_period", _r("score").alias("score"))


def t2_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of every document: their number, the longest one and all their characters."""
    found = materialize(sentences.abbreviations(docs(spark, d)), "abbreviations")
    out = sentences.split_sentences(docs(spark, d), found)
    size = F.length("sentence")
    return out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_sentences"), F.max(size).alias("longest"), F.sum(size).alias("n_chars"))


def _shape_tagged(spark: SparkSession, d: str) -> DataFrame:
    """Every token of every document with its split and its word-shape tag: the tables hold no tags to learn from."""
    from textlane.operators.text_chain import tag_expr
    t = sampling.split_by_hash(text.tokenize(docs_by_id(spark, d, "lang", "text")), "doc_id")
    return text.explode_tokens(t, keep=("lang", "split")).withColumn("tag", tag_expr(F.col("term")))


def t5_hmm_model(spark: SparkSession, d: str) -> DataFrame:
    """Counts of the Markov tagger trained on the train documents: neighbouring tags, (term, tag), (suffix, tag)."""
    tagged = _shape_tagged(spark, d).filter(F.col("split") == "train")
    counts = materialize(tagger.term_tags(tagged), "term-tags")
    rows = lambda df, kind, a: df.select(F.lit(kind).alias("kind"), F.col(a).alias("item"), "tag", "n")
    return (rows(tagger.tag_pairs(tagged), "pair", "previous").unionByName(rows(counts, "term", "term"))
            .unionByName(rows(tagger.suffix_tags(counts), "suffix", "suffix")))


def t5_hmm_tags(spark: SparkSession, d: str) -> DataFrame:
    """Test documents tagged by the trained Markov tagger: tokens by language, word-shape tag and trained tag."""
    tagged = materialize(_shape_tagged(spark, d), "shape-tagged")
    model = tagger.fit(tagged.filter(F.col("split") == "train"))
    model |= {k: materialize(model[k], f"tagger-{k}") for k in ("terms", "suffixes")}
    test = tagged.filter(F.col("split") == "test").withColumnRenamed("tag", "shape_tag")
    got = tagger.tag(test, model).select(F.col("doc_id").alias("_k"), F.col("pos").alias("_p"), "tag")
    joined = test.join(got, F.col("doc_id").eqNullSafe(F.col("_k")) & (F.col("pos") == F.col("_p")))
    return joined.groupBy("lang", "shape_tag", "tag").agg(F.count(F.lit(1)).alias("n_tokens"))


QUERIES = {f.__name__: f for f in (s1_json_scan, t2_abbreviations, t2_sentences, s6_model_roundtrip, s11_run_log, t2_treebank, t3_stopword_dir, t5_lexicon_tags, t5_hmm_model, t5_hmm_tags,
                                  f2_tfidf_train, e8_registry_eval, r8_run_status)}
