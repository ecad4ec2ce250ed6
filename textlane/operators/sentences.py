"""Sentences before words (T2): abbreviations are learned from the corpus, then periods that end a sentence are told apart.

A word type is an abbreviation of its language if it stands before a period far more often than words do by chance (the
log-likelihood ratio against the share of all words that do, after the published unsupervised method of Kiss and Strunk),
weighed by its length, its inner periods and its occurrences without a period.  Two aggregates give the scores: counts by
(language, type), and their sums by language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlane.functions.expr import tokens

#: A word with inner periods, and the period behind it if there is one.
TYPE_PATTERN = r"[\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*\.?"
#: The end of a sentence if no abbreviation stands before it; the mark between two pieces.
END_PATTERN, MARK = r"([.!?])[ \t\n\r]+(\p{Lu})", "\u001e"
#: Share of an abbreviation's occurrences with a period, and the least score of one: fixed values of the method.
ABBREVIATION_SHARE, MIN_SCORE = 0.99, 0.3


def type_scores(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``(lang, type, n, n_period, score)`` of every type that holds a letter and stands before a period."""
    rows = docs.select(F.col(lang).alias("lang"), F.explode(F.regexp_extract_all(F.col(text), F.lit(TYPE_PATTERN), 0)).alias("w"))
    rows = rows.select("lang", F.lower(F.regexp_replace("w", r"\.$", "")).alias("type"), F.endswith(F.col("w"), F.lit(".")).cast("long").alias("p"))
    counts = rows.groupBy("lang", "type").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("n_period"))
    share = counts.groupBy("lang").agg((F.sum("n_period") / F.sum("n")).alias("share"))      # one row per language
    kept = counts.filter((F.col("n_period") > 0) & F.col("type").rlike(r"\p{L}"))
    kept = kept.withColumnRenamed("lang", "_lang").join(share, F.col("_lang").eqNullSafe(F.col("lang"))).drop("_lang")
    without = F.col("n") - F.col("n_period")
    # 0 ln 0 is 0: where every word has a period, none is without one
    chance = F.col("n_period") * F.log("share") + F.when(without > 0, without * F.log(1 - F.col("share"))).otherwise(0.0)
    always = F.col("n_period") * F.log(F.lit(ABBREVIATION_SHARE)) + without * F.log(F.lit(1 - ABBREVIATION_SHARE))
    size = F.length(F.replace("type", F.lit("."), F.lit("")))
    weight = F.exp(-size) * (F.length("type") - size + 1) * F.pow(size.cast("double"), -without.cast("double"))
    return kept.select("lang", "type", "n", "n_period", (-2 * (chance - always) * weight).alias("score"))


def abbreviations(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``(lang, type)`` of the types whose score says abbreviation."""
    return type_scores(docs, lang, text).filter(F.round("score", 9) >= MIN_SCORE).select("lang", "type")


def split_sentences(docs: DataFrame, abbreviation: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text") -> DataFrame:
    """``(key, sentence_no, sentence)``, numbered from 0 in order.

    A sentence ends at ``.``, ``!`` or ``?`` before white space and a capital letter, unless a period there follows one of
    the language's abbreviations; the white space between sentences goes.  A null or empty text has no sentences.
    Keys must be unique.  Pieces are joined with the abbreviations by their last word; texts stay in pieces until the end.
    """
    pieces = docs.filter(F.length(text) > 0).select(F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.posexplode(
        F.split(F.regexp_replace(text, END_PATTERN, f"$1{MARK}$2"), MARK, -1)).alias("pos", "piece"))
    last = F.lower(F.regexp_extract("piece", r"([\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*)\.\z", 1))
    known = abbreviation.select(F.col("lang").alias("_l"), F.col("type").alias("_t"), F.lit(1).alias("_open"))
    pieces = pieces.withColumn("_last", last).join(known, F.col("_lang").eqNullSafe(F.col("_l")) & (F.col("_last") == F.col("_t")), "left")
    before = Window.partitionBy("_key").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum(F.when(F.col("_open").isNull(), 1).otherwise(0)).over(before), F.lit(0)).cast("int")
    parts = F.array_sort(F.collect_list(F.struct("pos", "piece")))
    return (pieces.select("_key", "pos", "piece", number.alias("sentence_no")).groupBy("_key", "sentence_no")
            .agg(F.array_join(F.transform(parts, lambda x: x["piece"]), " ").alias("sentence")).withColumnRenamed("_key", key))


def sentence_tokens(sentences: DataFrame, mode: str = "treebank") -> DataFrame:
    """``sentences`` with the ``tokens`` of each sentence."""
    return sentences.withColumn("tokens", tokens(F.col("sentence"), mode))
