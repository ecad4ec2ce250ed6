"""Source divergence audit: how far each source's term frequencies are from those of its language and of every other source.

All terms of a language count, also those that a source never uses: they have a small baseline probability, not none.
A divergence over all terms is put together from three parts, so that only terms that both sources use are looked at in pairs:

* a term of one group only, or of neither, meets a *baseline* that depends on the group alone.  Terms of equal count are
  alike there, so a group's histogram of counts gives its sum against every peer;
* terms that two groups share are summed row by row (Gustavson): a slice of the term-major index (term -> groups that use
  it) stays in memory, each group scatters its terms through it into one dense array over its peers, and only the finished
  sums per pair of groups leave the task.  No pair of postings is ever written or shuffled;
* each shared term was counted by the baselines before; its addend takes that back.

Arithmetic is in whole numbers and exact: a quotient is worked out by long division, in steps that stay within 64 bits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlane.llm.common import CHUNK, LOWER, UPPER, sorted_runs, spread, starts

MIN_DOCS, TOP_TERMS = 10, 10
SCALE, PRIOR = 1_000_000_000, 2
#: Postings in a slice of the index, about; (language, source, term) counts that a task gathers before it hands them on.
SLICE, GATHERED = 1 << 17, 300_000

#: A-Z to a-z, letters and all bytes of non-ASCII characters as they are, the rest to blanks.
_LETTERS = bytes(b if b >= 0x80 or chr(b) in LOWER else b + 32 if chr(b) in UPPER else 32 for b in range(256))


def _terms(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    raw, at = raw.translate(_LETTERS), 0
    while at < len(raw):
        cut = raw.find(b" ", at + 4 * CHUNK) if len(raw) - at > 4 * CHUNK else -1
        end = cut if cut >= 0 else len(raw)
        yield raw[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs): occurrences and documents, summed over what the task has gathered."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def gathered() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in found.items():
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(list(n), pa.binary()).cast(pa.string()),
                     pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])

    size = 0
    for batch in batches:
        for lang, source, raw in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            n, docs = found.setdefault((lang, source), (Counter(), Counter()))
            size -= len(n)
            own: set[bytes] = set()
            for terms in _terms(raw):
                n.update(terms)
                own.update(terms)
            docs.update(own)
            size += len(n)
            if size > GATHERED:
                yield from gathered()
                found, size = {}, 0
    yield from gathered()


def term_index(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The term-major index: (lang, term, total, postings array<struct<source, n>>) of the kept terms."""
    rows = docs.filter(F.col("text").isNotNull()).select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.col("text").cast("binary").alias("text"))
    counts = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # Dealt out by term once: both sums and the posting list of a term need no further shuffle.
    per_source = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return (per_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"),
                                                   F.sort_array(F.collect_list(F.struct("source", "n"))).alias("postings"))
            .filter(F.col("docs") >= min_docs).drop("docs"))


def probability(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (n + 2 v)), exact for denominators up to 9 * 10^15."""
    whole, rest = F.lit(0).cast("bigint"), count + PRIOR
    below = n + PRIOR * v
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + _div(rest, below), rest % below
    return whole + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))."""
    return _div((p - q) * (p - q), p + q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, h, value) of the pairs of groups that share terms in a slice: sums over the shared terms, less what the
    baselines count for them.

    Rows (slice, t, g, p, z) come sorted by slice and term: group g has probability p for term t, z for a term it lacks.
    """
    for table in sorted_runs(batches, ["slice"]):
        edges = [*starts(table, ["slice"]), table.num_rows]
        for low, high in zip(edges, edges[1:], strict=False):
            part = table.slice(low, high - low)
            g, p, z = (part.column(c).to_numpy() for c in ("g", "p", "z"))
            begin = starts(part, ["t"])
            term = np.repeat(np.arange(len(begin)), np.diff([*begin, part.num_rows]))
            end = np.append(begin[1:], part.num_rows)
            groups, own = np.unique(g, return_inverse=True)
            sums, seen = np.zeros(len(groups), dtype=np.int64), np.zeros(len(groups), dtype=bool)
            by_group = np.argsort(own, kind="stable")
            cut = np.searchsorted(own[by_group], np.arange(len(groups) + 1))
            out_g, out_h, out_v = [], [], []
            for k in range(len(groups)):
                mine = by_group[cut[k]:cut[k + 1]]
                size = (end - begin)[term[mine]]
                row = np.repeat(mine, size)                         # g's entry, once for each posting of its term
                at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[term[mine]], size)
                addend = _f(p[row], p[at]) - _f(p[row], z[at]) - _f(z[row], p[at]) + _f(z[row], z[at])
                np.add.at(sums, own[at], addend)
                seen[own[at]] = True
                seen[k] = False
                peers = np.flatnonzero(seen)
                out_g.append(np.full(len(peers), groups[k]))
                out_h.append(groups[peers])
                out_v.append(sums[peers])
                sums[own[at]], seen[own[at]] = 0, False
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_g, out_h, out_v)], names=["g", "h", "value"])


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Divergences of every (lang, source) group: lang, source, part, item, value, rank.

    docs: text, lang, source, null ones read as ''; other columns are ignored.  Terms are runs of A-Z, a-z and non-ASCII
    characters, A-Z lower-cased; a language keeps those in at least ``min_docs`` of its documents (rows; a repeated row
    counts each time).  Every occurring group has rows, also one without terms.  Part 'pair': one row per other source of
    the language, value summed over all kept terms (0 if there are none).  Part 'term': the ``top`` terms that the group
    uses more than its language.  Ranks go by value descending, then item.  Texts of any length are read whole, in
    pieces.  No documents give no rows; a language with one source has no pairs.

    Exact while a language has fewer than 9 * 10^15 kept occurrences.
    """
    index = spread(term_index(docs, min_docs).withColumn("t", F.monotonically_increasing_id()), "term-index")
    entries = index.select("lang", "t", "term", "total", F.explode("postings").alias("of")).select(
        "lang", "t", "term", "total", "of.source", "of.n")
    langs = index.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count("*").alias("terms"))
    names = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    zero = F.lit(0).cast("bigint")
    groups = names.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("group_n", "terms", "v", "lang_n")])
    # A language without kept terms has no baseline; its pairs are 0.
    z = F.when(F.col("v") > 0, probability(zero, F.col("group_n"), F.col("v"))).otherwise(zero)
    groups = spread(groups.withColumn("z", z).withColumn("g", F.monotonically_increasing_id()), "groups")

    entries = spread(entries.join(groups.select("lang", "source", "g", "group_n", "v", "lang_n", "z"), ["lang", "source"]).select(
        "g", "t", "term", "n", "z", probability(F.col("n"), F.col("group_n"), F.col("v")).alias("p"),
        probability(F.col("total"), F.col("lang_n"), F.col("v")).alias("q")), "probabilities")

    return _pairs(groups, entries).unionByName(_terms_above(groups, entries, top))


def _terms_above(groups: DataFrame, entries: DataFrame, top: int) -> DataFrame:
    above = entries.filter(F.col("p") > F.col("q")).select("g", "term", divergence(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), "term"))
    best = above.withColumn("rank", rank).filter(F.col("rank") <= top)
    return best.join(groups, "g").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(groups: DataFrame, entries: DataFrame) -> DataFrame:
    # Each group's terms, by probability, against the baselines of all peers: one dense array per group.
    histogram = (entries.groupBy("g", "p").agg(F.count("*").alias("n")).groupBy("g")
                 .agg(F.collect_list(F.struct("p", "n")).alias("histogram")))
    peers = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct(F.col("g").alias("h"), "z", "terms"))).alias("peers"))
    rows = groups.join(histogram, "g", "left").join(peers, "lang")
    nothing = F.lit(0).cast("bigint")

    def against(peer: Column) -> Column:
        """The group's terms as if the peer had none of them."""
        return F.aggregate(F.coalesce("histogram", F.array().cast("array<struct<p:bigint,n:bigint>>")), nothing,
                           lambda acc, x: acc + x["n"] * divergence(x["p"], peer["z"]))

    dense = F.transform("peers", lambda peer: F.struct(
        peer["h"].alias("h"), against(peer).alias("one"),
        F.when(F.col("v") > 0, (F.col("v") - F.col("terms") - peer["terms"]) * divergence(F.col("z"), peer["z"])).otherwise(nothing).alias("none")))
    base = spread(rows.select("g", F.explode(dense).alias("x")).select("g", "x.h", "x.one", "x.none").filter(F.col("g") != F.col("h")), "baselines")

    n_slices = max(1, entries.count() // SLICE)
    sliced = entries.select(F.pmod(F.xxhash64("t"), F.lit(n_slices)).alias("slice"), "t", "g", "p", "z")
    shared = (sliced.repartition("slice").sortWithinPartitions("slice", "t")
              .mapInArrow(_shared_terms, "g long, h long, value long"))
    parts = (base.select("g", "h", (F.col("one") + F.col("none")).alias("value"))
             .unionByName(base.select(F.col("h").alias("g"), F.col("g").alias("h"), F.col("one").alias("value"))).unionByName(shared))
    sums = parts.groupBy("g", "h").agg(F.sum("value").alias("value"))
    other = groups.select(F.col("g").alias("h"), F.col("source").alias("item"))
    named = sums.join(groups.select("g", "lang", "source"), "g").join(other, "h")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
