"""Benchmark decontamination: SimHash windows of item size, multi-index Hamming search, exact verification.

Items and documents are lower-cased words without ASCII punctuation, in five-word shingles.  An item of m shingles is
searched by windows of its size class S (about 0.8 m, on a grid): its first and last S-windows have SimHash fingerprints,
and a document is fingerprinted at a stride so small that each place where the whole item could stand contains a
window that is aligned with one of the item's first and one of its last.  Work per document word is a few windows,
whatever the number of items.

Fingerprints within ``RADIUS`` of 64 bits are all found (windows at the similarity of 0.8 differ in about 10 bits on average, so
the radius is well above that): four blocks of 16 bits are looked up with all values within
RADIUS // 4 of theirs (two strings within RADIUS agree up to RADIUS // 4 in at least one of four blocks), and the
whole distance is checked.  Each hit is then verified by the weighted Jaccard similarity (shingles weighted by their
multiplicity) of the item and the item-sized window of the document.

The items are a stated query set: they are searched in blocks of ``ITEM_BLOCK``, each held by every task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textlane.llm.common import hashed_words, shingles

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 15
#: Items that a task holds at a time (expected; items are dealt to blocks by hash).
ITEM_BLOCK = 2000
#: So many shingles are fingerprinted at a time: short texts together, long ones in pieces that overlap by the longest item.
PIECE = 1 << 16
#: Size classes of windows, in shingles: each about a quarter above the last.
GRID = tuple(dict.fromkeys(int(np.ceil(1.25 ** k)) for k in range(60)))

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def text_shingles(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Each text's shingle hashes in order; none for a text of fewer than five words."""
    raws = [(t or "").lower().encode("utf-8", "surrogatepass").translate(None, _PUNCTUATION) for t in texts]
    for words in hashed_words(raws):
        yield shingles(words, WIDTH) if len(words) >= WIDTH else words[:0]


def size_class(m: int) -> int:
    """The greatest grid size up to 0.8 m (1 at least, MAX_SIZE at most)."""
    return max(g for g in GRID if g <= min(MAX_SIZE, max(1, int(0.8 * m))))


#: The eight bits of a byte, each in a lane of eight bits; and the factor that gathers the lanes' lowest bits again.
_LANES = np.array([sum(((b >> i) & 1) << (8 * i) for i in range(8)) for b in range(256)], dtype=np.uint64)
_EVERY, _GATHER, _TOP = np.uint64(0x0101010101010101), np.uint64(0x0102040810204080), np.uint64(56)
#: Lanes hold counts up to 255, so windows have at most so many shingles.
MAX_SIZE = 255


def prefix_bits(values: np.ndarray) -> np.ndarray:
    """Running counts of the set bits of each of the 64 places, eight lanes to a number, with a zero first.

    Lanes run over into each other in the sums, but the difference of two sums is again exact while no lane of it passes 255.
    """
    out = np.zeros((8, len(values) + 1), dtype=np.uint64)
    for k in range(8):
        np.cumsum(_LANES[(values >> np.uint64(8 * k)) & np.uint64(255)], out=out[k, 1:])
    return out


def window_prints(prefix: np.ndarray, size: int, stride: int = 1) -> np.ndarray:
    """SimHash fingerprints of the windows of ``size`` shingles at every ``stride``: the places where most bits are set."""
    n = prefix.shape[1] - size
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    ones = prefix[:, size::stride] - prefix[:, :n:stride]
    ones += _EVERY * np.uint64(127 - size // 2)   # the lane's top bit is now set if more than half of the bits were
    ones >>= np.uint64(7)
    ones &= _EVERY
    ones *= _GATHER
    ones >>= _TOP
    out = ones[0]
    for k in range(1, 8):
        out = out | (ones[k] << np.uint64(8 * k))
    return out


class BlockIndex:
    """Fingerprints found by any of four 16-bit blocks within a quarter of the radius."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS) -> None:
        self.prints, self.radius = prints, radius
        near = [np.zeros(1, dtype=np.uint16)]
        bit = (1 << np.arange(16)).astype(np.uint16)
        ring = near[0]
        for _ in range(radius // 4):
            ring = np.unique((ring[:, None] ^ bit[None, :]).ravel())
            near.append(ring)
        masks = np.unique(np.concatenate(near))
        self.tables = []
        for b in range(4):
            own = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.uint16)
            keys = (own[:, None] ^ masks[None, :]).astype(np.int64).ravel()
            which = np.repeat(np.arange(len(prints)), len(masks))
            order = np.argsort(keys, kind="stable")
            self.tables.append((np.searchsorted(keys[order], np.arange(65537)), which[order]))

    def search(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in prints, place in the index) of every pair within the radius; a pair can come more than once."""
        found_a, found_b = [], []
        for b, (begin, which) in enumerate(self.tables):
            key = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            low, n = begin[key], begin[key + 1] - begin[key]
            some = np.flatnonzero(n)
            if not len(some):
                continue
            n, low = n[some], low[some]
            a = np.repeat(some, n)
            c = which[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            ok = np.bitwise_count(prints[a] ^ self.prints[c]) <= self.radius
            found_a.append(a[ok])
            found_b.append(c[ok])
        if not found_a:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_a), np.concatenate(found_b)


class Items:
    """A block of items, indexed by size class."""

    def __init__(self, rows: list[tuple], radius: int) -> None:
        self.ids, self.shingles = [], []
        for (item_id, _), s in zip(rows, text_shingles([text for _, text in rows]), strict=True):
            if len(s):
                self.ids.append(item_id)
                self.shingles.append(s)
        self.counts = [Counter(s.tolist()) for s in self.shingles]
        self.longest = max((len(s) for s in self.shingles), default=0)
        of_class: dict[int, list[int]] = {}
        for k, s in enumerate(self.shingles):
            of_class.setdefault(size_class(len(s)), []).append(k)
        self.classes = []
        for size, members in sorted(of_class.items()):
            # Any run of m shingles contains windows of a document that begin at multiples of this stride: one among the
            # first and one among the last ``stride`` windows of the item, so those are indexed.
            stride = min(len(self.shingles[k]) for k in members) - size + 1
            prints, item, offset = [], [], []
            for k in members:
                last = len(self.shingles[k]) - size + 1
                at = np.unique(np.concatenate([np.arange(stride), np.arange(last - stride, last)]))
                prints.append(window_prints(prefix_bits(self.shingles[k]), size)[at])
                item.append(np.full(len(at), k))
                offset.append(at)
            self.classes.append((size, stride, BlockIndex(np.concatenate(prints), radius), np.concatenate(item), np.concatenate(offset)))


def similarity(window: np.ndarray, counts: Counter, m: int) -> float:
    """Weighted Jaccard of a window's shingles and an item's counts: sum of least over sum of greatest multiplicities."""
    own = Counter(window.tolist())
    least = sum(min(n, counts[s]) for s, n in own.items() if s in counts)
    return least / (len(window) + m - least)


def _search(rows: list[tuple], id_type: pa.DataType, threshold: float, radius: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(rows, radius)
        for batch in batches:
            places, items_found, starts, sims, ends = [], [], [], [], []
            for place, item, start, sim in _hits(batch.column("text").to_pylist(), items, threshold):
                places.append(place)
                items_found.append(items.ids[item])
                starts.append(start)
                ends.append(start + len(items.shingles[item]) + WIDTH - 1)
                sims.append(sim)
            found = batch.take(pa.array(places, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [found.column("doc_id"), found.column("text_key"), pa.array(items_found, id_type),
                 pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(sims, pa.float64())],
                names=["doc_id", "text_key", "item", "start_word", "end_word", "similarity"])
    return scan


def _hits(texts: list[str | None], items: Items, threshold: float) -> Iterator[tuple[int, int, int, float]]:
    """(place, item, first word, similarity) of the best window of every (text, item) that reaches the threshold."""
    if not items.classes:
        return
    own: dict[int, np.ndarray] = {}
    best: dict[tuple[int, int], tuple[float, int]] = {}
    parts: list[tuple[int, int, np.ndarray]] = []
    size = 0
    for place, s in enumerate(text_shingles(texts)):
        # Pieces begin at multiples of PIECE and overlap by the longest item, so no occurrence is cut in all of them.
        for base in range(0, len(s), PIECE):
            own[place] = s
            part = s[base:base + PIECE + items.longest]
            if parts and size + len(part) > PIECE:
                _look(parts, own, items, threshold, best)
                parts, size, own = [], 0, {place: s}
            parts.append((place, base, part))
            size += len(part)
    if parts:
        _look(parts, own, items, threshold, best)
    for (place, item), (value, start) in best.items():
        yield place, item, start, -value


def _look(parts: list[tuple[int, int, np.ndarray]], own: dict[int, np.ndarray], items: Items, threshold: float,
          best: dict[tuple[int, int], tuple[float, int]]) -> None:
    """Searches the parts (place, first shingle, shingles), laid end to end, and notes the best verified windows."""
    prefix = prefix_bits(np.concatenate([s for _, _, s in parts]))
    ends = np.cumsum([len(s) for _, _, s in parts])
    places, bases = np.array([p for p, _, _ in parts]), np.array([b for _, b, _ in parts]) - (ends - [len(s) for _, _, s in parts])
    for size, stride, index, item_of, offset_of in items.classes:
        prints = window_prints(prefix, size, stride)
        at = np.arange(len(prints)) * stride
        part = np.searchsorted(ends, at, side="right")
        inside = np.flatnonzero(at + size <= ends[part]) if len(at) else at   # windows over two texts don't count
        found, which = index.search(prints[inside])
        found = inside[found]
        seen = zip(places[part[found]].tolist(), item_of[which].tolist(),
                   (at[found] + bases[part[found]] - offset_of[which]).tolist(), strict=True)
        for place, item, start in sorted(set(seen)):
            s, m = own[place], len(items.shingles[item])
            start = max(0, min(start, len(s) - m))   # the item-sized window, moved inside the text
            value = similarity(s[start:start + m], items.counts[item], m)
            if value >= threshold and (-value, start) < best.get((place, item), (1.0, 0)):
                best[place, item] = (-value, start)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS,
                 item_block: int = ITEM_BLOCK) -> DataFrame:
    """doc_id, text_key, item_id, start_word, end_word, similarity: the best window of every document row and item that match.

    docs: doc_id, text; benchmark: item_id, text; other columns are not read.  text_key is the md5 of the text.  Words are
    counted from 0, in the text without ASCII punctuation.  Null and empty texts and those of fewer than five words (on
    either side) match nothing; equal items each match; a repeated document row gives its matches each time; of equally
    similar windows the first is given.  An empty table on either side gives an empty one.
    """
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).distinct()
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-items.count() // item_block)))))
    rows = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), "text").filter(F.col("text").isNotNull())
    kind = docs.schema["doc_id"].dataType.simpleString()
    item = benchmark.schema["item_id"].dataType
    schema = f"doc_id {kind}, text_key string, item {item.simpleString()}, start_word long, end_word long, similarity double"
    out = None
    for block in sorted(r.block for r in items.select("block").distinct().collect()):
        # At most about item_block items: the bound of what a task and the driver hold.
        chosen = [(r.item_id, r.text) for r in items.filter(F.col("block") == block).sort("item_id", "text").collect()]
        found = rows.mapInArrow(_search(chosen, to_arrow_type(item), threshold, radius), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnRenamed("item", "item_id")
