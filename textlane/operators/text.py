"""Text operators: tokenize, stop words, stem, noun filter, whole chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlane.functions.expr import tokens as token_expr
from textlane.functions.stopwords import ENGLISH_STOPWORDS


def tokenize(df: DataFrame, text: str = "text", out: str = "tokens",
             mode: str = "words") -> DataFrame:
    """Add an ``array<string>`` column of lower-cased tokens (T1 + T2)."""
    return df.withColumn(out, token_expr(F.col(text), mode))


def drop_stopwords_array(tokens: Column, words=ENGLISH_STOPWORDS) -> Column:
    """Array form of stop-word removal: order and duplicates are kept.

    ``isin`` over a literal list becomes a JVM hash-set lookup (``InSet``),
    so this stays inside whole-stage codegen.
    """
    words = list(dict.fromkeys(w.lower() for w in words))
    return F.filter(tokens, lambda t: ~F.lower(t).isin(words))


def remove_stopwords(df: DataFrame, tokens: str = "tokens", words=ENGLISH_STOPWORDS) -> DataFrame:
    return df.withColumn(tokens, drop_stopwords_array(F.col(tokens), words))


def explode_tokens(df: DataFrame, key: str = "doc_id", tokens: str = "tokens",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Long form ``(key, *keep, pos, term)``; positions keep the word order.

    ``posexplode_outer`` + a null filter gives the rows of ``posexplode``
    but keeps the optimizer from inferring a ``size(tokens) > 0`` filter
    under the generator: that filter is pushed below the exchange and would
    run the whole tokenizer a second time per row.
    """
    return (df.select(key, *keep, F.posexplode_outer(tokens).alias("pos", "term"))
            .filter(F.col("term").isNotNull()))


def remove_stopwords_table(long_df: DataFrame, stop_df: DataFrame,
                           lang_col: str | None = None) -> DataFrame:
    """Table form: left-anti join to a ``(lang, term)`` stop-word table.

    The stop-word table is a fixed, small list (hundreds of rows per
    language), so it is broadcast; the token side is never shuffled.
    """
    stop = stop_df.select(*( [F.col("lang").alias(lang_col)] if lang_col else []),
                          F.lower("term").alias("term")).distinct()
    keys = ([lang_col] if lang_col else []) + ["term"]
    return long_df.join(F.broadcast(stop), keys, "left_anti")


def rebuild_text(long_df: DataFrame, key: str = "doc_id", pos: str = "pos",
                 term: str = "term", out: str = "processed_text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Join kept tokens back into one string per key (and ``keep``), in position order (T6).

    Sorting ``(pos, term)`` structs inside each group keeps the order right
    after a shuffle, whatever order the rows arrive in.
    """
    return (long_df.groupBy(*keep, key)
            .agg(F.array_sort(F.collect_list(F.struct(pos, term))).alias("_p"))
            .select(*keep, key, F.array_join(F.transform("_p", lambda s: s[term]), " ").alias(out)))
