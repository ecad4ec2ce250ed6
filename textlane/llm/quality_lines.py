"""Quality rules with cross-document line frequency.

Base rules look at one document: word counts, symbols, repeated lines and
words inside repeated eight-word windows.  The method looks across documents:
normalised lines are hashed per host, distinct texts per (host, line) are
counted, lines above the limit are taken out, and a document of which too
few words are left is rejected as depleted.  The limit is a number of texts,
not a share of the host's, so that a verdict does not loosen as the host grows.

Distinct *texts* are counted, so that a text is not rejected for having many
exact copies (removing copies is another operator's work).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlane.llm.common import ASCII_SPACE, hashed_words, line_hash, lines_of, normal_line, shingles, spread, text_of

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
#: A line is removed if at least so many of its host's distinct texts have it.
MIN_LINE_DOCS = 10
#: A document is depleted if less than this share of its words is left.
MIN_LEFT_SHARE = 0.3

_SPACE_BYTES = ASCII_SPACE.encode()
_SYMBOL_BYTES = SYMBOLS.encode()


def repeat_words(words: np.ndarray) -> int:
    """Words inside eight-word windows that the text has twice or more."""
    n = len(words)
    if n <= REPEAT_WINDOW:
        return 0
    windows = shingles(words, REPEAT_WINDOW)
    order = np.argsort(windows, kind="stable")
    equal = windows[order][1:] == windows[order][:-1]
    if not equal.any():
        return 0
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[:len(windows)] += twice
    edge[REPEAT_WINDOW:REPEAT_WINDOW + len(windows)] -= twice
    return int((np.cumsum(edge)[:n] > 0).sum())


def text_metrics(text: str, raw: bytes, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text, its bytes and its words' hashes."""
    if not len(words):
        return 0, 0, len(raw) - len(raw.translate(None, _SYMBOL_BYTES)), 0, 0
    word_chars = len(text) - (len(raw) - len(raw.translate(None, _SPACE_BYTES)))
    symbols = len(raw) - len(raw.translate(None, _SYMBOL_BYTES))
    lines = [x for x in raw.split(b"\n") if x.strip()]   # bytes: strips exactly the ASCII white space
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in METRICS.split(", ")]
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        raws = [t.encode("utf-8", "surrogatepass") for t in texts]
        rows = [text_metrics(*x) for x in zip(texts, raws, hashed_words(raws), strict=True)]
        found = [pa.array([r[k] for r in rows], type=pa.int64()) for k in range(len(names))]
        keep = ["doc_id", "text_in_host"]
        yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + found, names=keep + names)


def _keyed(docs: DataFrame, host: str) -> DataFrame:
    """doc_id, text, host_key and text_in_host (hashes of the host, and of the host and text)."""
    return docs.select("doc_id", "text", F.xxhash64(host).alias("host_key"),
                       F.xxhash64(host, text_of()).alias("text_in_host"))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, pos, keys, words = [], [], [], []
        for row, raw in enumerate(batch.column("text").to_pylist()):
            for k, line in enumerate(raw.split(b"\n")):
                key = normal_line(line)
                if key:
                    rows.append(row)
                    pos.append(k)
                    keys.append(line_hash(key))
                    words.append(len(key.split()))
        own = batch.select(["host_key", "text_in_host"]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([*own.columns, pa.array(pos, pa.int32()), pa.array(keys, pa.int64()),
                                          pa.array(words, pa.int32())], names=["host_key", "text_in_host", "pos", "key", "words"])


def host_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """host_key, text_in_host, pos, key, words: the non-blank lines of each distinct text of a host, once."""
    rows = _keyed(docs.filter(F.col("text").isNotNull()), host).withColumn("text", F.col("text").cast("binary")).mapInArrow(
        _lines, "host_key long, text_in_host long, pos int, key long, words int")
    # Copies of a text give equal rows; they meet in the map-side combine first.
    return rows.groupBy("host_key", "text_in_host", "pos").agg(F.first("key").alias("key"), F.first("words").alias("words"))


def common_lines(lines: DataFrame, min_docs: int = MIN_LINE_DOCS) -> DataFrame:
    """host_key, key of the lines that at least ``min_docs`` distinct texts of the host have."""
    return (lines.groupBy("host_key", "key").agg(F.count_distinct("text_in_host").alias("n"))
            .filter(F.col("n") >= min_docs).select("host_key", "key"))


def judge(docs: DataFrame, host: str = "source", min_docs: int = MIN_LINE_DOCS,
          min_left: float = MIN_LEFT_SHARE) -> DataFrame:
    """Metrics and verdict of every document row.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, removed_words, kept and text_in_host (hash of
    host and text; the verdict is a function of it).

    docs: doc_id, text and the host column; other columns are not read.  A null
    or empty text has no words and fails the base rules.  The null host is a
    host of its own.  Repeated rows give a row each and count as one text.  An
    empty table gives an empty one.
    """
    lines = spread(host_lines(docs, host), "host-lines")
    common = spread(common_lines(lines, min_docs), "host-common-lines")
    removed = spread(lines.join(common, ["host_key", "key"], "left_semi")
                     .groupBy("text_in_host").agg(F.sum("words").cast("bigint").alias("removed_words")), "host-removed")
    rows = _keyed(docs, host).mapInArrow(_measure, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                                                   f"text_in_host long, {METRICS}")
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    rows = rows.join(removed, "text_in_host", "left").withColumn(
        "removed_words", F.coalesce("removed_words", F.lit(0).cast("bigint")))
    left = F.col("n_words") - F.col("removed_words")
    return rows.withColumn("kept", ~F.col("base_failed") & (left >= F.lit(min_left) * F.col("n_words"))).select(
        "doc_id", *[x.split()[0] for x in METRICS.split(", ")], "base_failed", "kept", "removed_words", "text_in_host")


def strip_common_lines(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """text_in_host, kept_text of each distinct text that loses lines: its text without the lines above the limit."""
    lines = spread(host_lines(docs, host), "host-lines")
    common = spread(common_lines(lines, **limits), "host-common-lines")
    drops = (lines.join(common, ["host_key", "key"], "left_semi")
             .groupBy("text_in_host").agg(F.collect_set("pos").alias("drop_pos")))
    texts = _keyed(docs, host).select("text_in_host", "text").dropDuplicates(["text_in_host"])
    rows = texts.join(drops, "text_in_host").withColumn("lines", lines_of(F.col("text")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop_pos"))
    return rows.select("text_in_host", F.array_join(F.transform(stay, lambda p: F.get(F.col("lines"), p)), "\n")
                       .alias("kept_text"))
