"""Filter interaction audit: what five filters remove, alone, together and in every order.

Filters, by letter: A under 50 words; B fewer than 65 distinct words per 100; C more than 5 capital letters per 100 code
points; D one of ``#$%&*|``; E a text that a smaller doc_id has too.  A to D look at one document.  E is an existential
self-join: documents left-semi joined with the table itself on the text's hash, the exact text and a smaller doc_id.  Its
ids are put together (union) with those of the other failures, and the bit combinations of all documents are counted.

Any smaller doc_id exists if the least one of a text is smaller, so the right side of the self-join is one row per text,
aggregated before the shuffle; copies are never paired.  Only texts whose hash two doc_ids share enter it.  A combination
is one of 32, whatever the size of the table; all 120 orders are read from those counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlane.llm.common import CHUNK, UPPER, spread, text_of

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 50, 65, 5
SYMBOLS = "#$%&*|"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
_BIT = {f: 1 << k for k, f in enumerate(FILTERS)}
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_counts(raw: bytes) -> tuple[int, int]:
    """Words and distinct words; a long text is split piece by piece, so that its words are never held all at once."""
    n, seen, at = 0, set(), 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + CHUNK) if len(raw) - at > CHUNK else None
        end = cut.start() if cut else len(raw)
        words = raw[at:end].split()     # of bytes: at ASCII white space
        n += len(words)
        seen.update(words)
        at = end
    return n, len(seen)


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text`` replaced by the bits of A to D."""
    capitals, symbols = UPPER.encode(), re.compile(b"[" + re.escape(SYMBOLS.encode()) + b"]")
    for batch in batches:
        text = batch.column("text")
        points = pc.utf8_length(text).to_numpy(zero_copy_only=False)
        bits = np.zeros(batch.num_rows, dtype=np.int32)
        for row, raw in enumerate(text.cast(pa.large_binary() if pa.types.is_large_string(text.type) else pa.binary()).to_pylist()):
            n, distinct = _word_counts(raw)
            upper = len(raw) - len(raw.translate(None, capitals))
            bits[row] = (_BIT["A"] * (n < MIN_WORDS) | _BIT["B"] * (100 * distinct < MIN_DISTINCT * n)
                         | _BIT["C"] * (100 * upper > MAX_CAPITALS * int(points[row])) | _BIT["D"] * (symbols.search(raw) is not None))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "h", "part")), pa.array(bits)],
                                         names=["doc_id", "h", "part", "bits"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of()).alias("h"),
                       F.coalesce(F.col("source"), F.lit("")).alias("part"), text_of().alias("text"))


def copies_of_smaller(docs: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """(doc_id, h, part) of the documents whose text a smaller doc_id has too.

    docs: doc_id, text, source.  keys: their (doc_id, h) if known.  A null doc_id is neither smaller nor larger.  Hashes
    choose which texts are compared; that they are equal is decided by the texts.
    """
    rows = _keyed(docs)
    shared = ((keys if keys is not None else rows).groupBy("h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
              .filter(F.col("least") < F.col("most")).select("h"))
    # Texts go to their hash once, whatever the number of shared hashes; a set of those is all that a task holds.  What both
    # joins look up is written first: then Spark can split the rows of a text with many copies.
    rows = spread(rows.join(spread(shared, "shared-hashes").hint("shuffle_hash"), "h", "left_semi"), "texts-of-shared-hashes")
    least = spread(rows.groupBy("h", "text").agg(F.min("doc_id").alias("least")), "least-ids")
    own, first = rows.alias("own"), least.alias("first")
    same = (F.col("own.h") == F.col("first.h")) & (F.col("own.text") == F.col("first.text"))
    found = own.join(first, same & (F.col("first.least") < F.col("own.doc_id")), "left_semi")
    return found.select("doc_id", "h", "part").distinct()


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents by part and combination of failures."""
    single = spread(_keyed(docs).mapInArrow(_single, "doc_id long, h long, part string, bits int"), "single-failures")
    repeated = copies_of_smaller(docs, single.select("doc_id", "h"))
    failures = (single.withColumn("n", F.lit(1).cast("bigint"))
                .unionByName(repeated.select("doc_id", "h", "part", F.lit(_BIT["E"]).alias("bits"), F.lit(0).cast("bigint").alias("n"))))
    of_doc = failures.groupBy("doc_id", "h", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    marks = (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic")))
    known = of_doc.filter(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left").select(
        "part", "bits", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    rows = known.unionByName(of_doc.filter(F.col("doc_id").isNull()).select(
        "part", "bits", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic")))
    return rows.groupBy("part", "bits").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                                            F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def _bits_of(letters: Column) -> Column:
    """The bits of a string of filter letters."""
    bits = [F.when(F.contains(letters, F.lit(f)), F.lit(b)).otherwise(F.lit(0)) for f, b in _BIT.items()]
    return sum(bits[1:], bits[0])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part (source), order of the filters and step: what its filter removes, and whether others would have.

    docs: doc_id, text, source; labels: doc_id, quality, toxic.  Other columns are ignored.  A null text is empty (it fails
    A), a null source the part ''.  Each row is a document, repeated rows too: of equal rows none is a copy of the other,
    as their doc_id is not smaller.  A null doc_id is never a copy and has no label.  A doc_id with several labels is
    good or toxic if one of them says so.  Texts of any length are read whole, in pieces.  No documents give no rows.

    Returns part, filter_order, step (1 to 5), and the long counts kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley (the filter's removals, summed over all 120 orders).
    """
    counts = F.sort_array(F.collect_list(F.struct("bits", "n", "good", "toxic")))    # 32 at most
    per_part = combinations(docs, labels).groupBy("part").agg(counts.alias("counts"))
    steps = (per_part.select("part", "counts", F.explode(F.array(*[F.lit(o) for o in ORDERS])).alias("filter_order"))
             .select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
             .withColumn("bit", _bits_of(F.expr("substr(filter_order, step, 1)")))
             .withColumn("before", _bits_of(F.expr("substr(filter_order, 1, step - 1)"))))

    def total(what: str, holds) -> Column:
        """Sum of a count over the combinations for which ``holds(bits)``."""
        return F.aggregate("counts", F.lit(0).cast("bigint"), lambda acc, c: acc + F.when(holds(c["bits"]), c[what]).otherwise(0))

    bit, before = F.col("bit"), F.col("before")
    here = lambda b: (b.bitwiseAND(bit) != 0) & (b.bitwiseAND(before) == 0)
    # A document that fails k filters is removed by each of them in 120 / k orders.
    shares = F.aggregate("counts", F.lit(0).cast("bigint"), lambda acc, c: acc + F.when(
        c["bits"].bitwiseAND(bit) != 0, (F.lit(len(ORDERS)) / F.bit_count(c["bits"])).cast("bigint") * c["n"]).otherwise(0))
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda b: b.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda b: (b.bitwiseAND(bit) != 0) & (b.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda b: b == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"), shares.alias("shapley"))
