"""Small native column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token rules.  ``words`` is the vectorizer-style rule: runs of two or more
# letters, digits or underscores (Unicode classes, so Java and RE2 agree).
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
# ``treebank`` keeps contractions and single punctuation marks as their own tokens: contractions are set off by
# blanks first, so that no rule needs to look around.
CONTRACTIONS = [
    (r"([\p{L}\p{N}_])n't([^\p{L}\p{N}_]|$)", "$1 n't $2"),
    (r"([\p{L}\p{N}_])('(?:ll|re|ve|s|m|d))([^\p{L}\p{N}_]|$)", "$1 $2 $3"),
]
TREEBANK_PATTERN = (
    r"n't|'(?:ll|re|ve|s|m|d)"
    r"|\p{N}+(?:[.,]\p{N}+)*"
    r"|[\p{L}\p{N}_]+(?:-[\p{L}\p{N}_]+)*"
    r"|[^ \t\n\r\f\x0b\p{L}\p{N}_]"
)
TOKEN_PATTERNS = {"words": WORD_PATTERN, "treebank": TREEBANK_PATTERN}


def tokens(text: Column, mode: str = "words") -> Column:
    """Lower-case ``text`` and split it into an array of tokens."""
    text = F.lower(text)
    if mode == "treebank":
        for pattern, apart in CONTRACTIONS:
            text = F.regexp_replace(text, pattern, apart)
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERNS[mode]), 0)


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """Deterministic number in [0, 1) from key columns and a seed.

    First 32 bits of md5 over ``key|seed``; the same value is reachable in
    plain SQL engines, so splits and samples can be checked by an oracle.
    """
    key = F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_key(*cols: Column, seed: int = 0) -> Column:
    """md5 hex string of ``key|seed`` (sortable pseudo-random order)."""
    key = F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed)))
    return F.md5(key)


def plus_concat(a: Column, b: Column, sep: str = " + ") -> Column:
    """``a + sep + b`` with null propagation (``concat``, not ``concat_ws``)."""
    return F.concat(a, F.lit(sep), b)


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
