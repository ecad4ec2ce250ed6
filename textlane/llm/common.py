"""Helpers shared by the training-data operators: text expressions, word hashes, runs of sorted batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlane.session import materialize

#: The white space of every word rule here: blank and U+0009..U+000D.
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(col: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def lines_of(text: Column) -> Column:
    """Array of the ``\\n``-split lines; an empty text has one empty line."""
    return F.split(text, "\n", -1)


def order_hash(*cols: Column, seed: str = "") -> Column:
    """md5 hex of the columns (nulls as empty): a seeded order that any SQL engine can repeat."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def spread(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back (lineage cut that survives lost executors)."""
    return materialize(df, name)


# --- inside tasks -----------------------------------------------------------------------------------------------------

MASK = (1 << 64) - 1
#: Odd multipliers of the mixing function below and of the five words of a shingle.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit values of 64-bit values."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)


#: Texts are hashed together in chunks of about so many bytes.
CHUNK = 1 << 18
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[ord(c) for c in ASCII_SPACE]] = True
_CUT = re.compile(rb"[\x20\x09-\x0D]")
#: A byte's value, powers of an odd base and of its inverse modulo 2^64: a word's hash is its polynomial, wherever it stands.
_BYTE = seeds(256, 11)
_BASE = int(seeds(1, 13)[0])
_LENGTH = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % (1 << 64), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER, _INVERSE = _powers(_BASE, 2 * CHUNK), _powers(pow(_BASE, -1, 1 << 64), 2 * CHUNK)


def _hash_chunk(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and where each text's words begin (and the last ones end)."""
    joined = np.frombuffer(b"\n".join(raws) + b"\n", dtype=np.uint8)
    space = _SPACE[joined]
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        change = np.concatenate([[0], change])
    begin, end = change[::2], change[1::2]
    total = np.zeros(len(joined) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[joined] * _POWER[:len(joined)], out=total[1:])
    hashes = mix((total[end] - total[begin]) * _INVERSE[begin] + (end - begin).astype(np.uint64) * _LENGTH)
    edges = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])])
    return hashes, np.searchsorted(begin, edges)


def _pieces(raw: bytes) -> list[bytes]:
    """A long text cut at white space into pieces of about CHUNK bytes (a longer word stays whole up to the end)."""
    out, at = [], 0
    while len(raw) - at > CHUNK:
        cut = _CUT.search(raw, at + CHUNK // 2, at + CHUNK)
        if cut is None:
            # One word longer than a piece: hash what it is, as a word of its own.
            cut = _CUT.search(raw, at + CHUNK)
            stop = cut.start() if cut else len(raw)
            begin = max(raw.rfind(c, at, at + CHUNK) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")) + 1 or at
            out += [raw[at:begin], b"%x" % xxhash.xxh3_64_intdigest(raw[begin:stop])]
            at = stop
        else:
            out.append(raw[at:cut.start()])
            at = cut.start()
    return [*out, raw[at:]]


def hashed_words(raws: list[bytes]) -> Iterator[np.ndarray]:
    """The 64-bit hashes of each text's words (runs without ASCII white space), text by text."""
    at = 0
    while at < len(raws):
        if len(raws[at]) > CHUNK:
            yield np.concatenate([_hash_chunk([x])[0] for x in _pieces(raws[at])])
            at += 1
            continue
        end, size = at, 0
        while end < len(raws) and size + len(raws[end]) <= CHUNK:
            size += len(raws[end]) + 1
            end += 1
        hashes, bounds = _hash_chunk(raws[at:end])
        for low, high in zip(bounds, bounds[1:], strict=False):
            yield hashes[low:high]
        at = end


_SHINGLE = seeds(64, 77)


def shingles(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """One 64-bit hash per run of ``width`` words, in order; a shorter text is one shingle, an empty one none."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(width, n)
    total = hashes[:n - width + 1] * _SHINGLE[0]
    for k in range(1, width):
        total += hashes[k:n - width + 1 + k] * _SHINGLE[k]
    return mix(total)


def normal_line(line: bytes) -> bytes:
    """The line's key: without outer ASCII white space, A-Z lower-cased (bytes methods know ASCII only)."""
    return line.strip().lower()


def line_hash(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key) - (1 << 63)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys, from batches sorted by the keys.

    Each table holds one or more complete runs; only the last, unfinished run
    of a batch is carried over to the next one.
    """
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        at = starts(table, keys)[-1]
        if at:
            yield table.slice(0, at)
        rest = table.slice(at)
    if rest is not None and rest.num_rows:
        yield rest


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a run of equal (integer) keys begins."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of the keys."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[k])
    return out
