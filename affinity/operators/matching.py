"""Equality + substring ("text contains pattern") join.

``texts.join(patterns, eq & contains(text, pattern))`` would be planned as a
hash join on the equality keys with ``contains`` as a residual check, which
compares every text with every pattern of its key group: quadratic in the
group size.  This operator is exact and linear instead.  Within each key
group, every distinct pattern length cuts each text into its substrings of
that length.  The (deduplicated) substrings then equi-join the patterns on
(keys, substring = pattern).  Per text row the work is
``len(text) x distinct pattern lengths in its group``, which is bounded by
string lengths, not by the number of rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators.sizing import maybe_broadcast

def contains_join(texts: DataFrame, patterns: DataFrame, text_col: str, pattern_col: str,
                  on: Sequence[tuple[str, str]] = (), small: bool = False) -> DataFrame:
    """Inner join of ``texts`` and ``patterns`` where ``text_col`` contains
    ``pattern_col`` and each ``(text_key, pattern_key)`` pair in ``on`` is
    equal.  Every matching (text row, pattern row) pair appears once, as in
    the nested-loop form; multi-matches are kept.

    With ``small`` (the caller has checked the size of the patterns' source)
    the patterns are broadcast, so the texts and their substrings are never
    shuffled; otherwise the planner and AQE choose, and AQE splits skewed
    partitions.

    Column names of the two inputs must not overlap, except that an ``on``
    pair may use the same name on both sides (it then appears once).
    """
    tkeys = [a for a, _ in on]
    pkeys = [b for _, b in on]
    kn = [f"_k{i}" for i in range(len(on))]

    lengths = (patterns
               .where(F.col(pattern_col).isNotNull())
               .select(*[F.col(p).alias(k) for p, k in zip(pkeys, kn)],
                       F.length(pattern_col).alias("_len"))
               .distinct())
    t = texts.select("*", *[F.col(c).alias(k) for c, k in zip(tkeys, kn)])
    if kn:
        # one row per (text row, pattern length present in its key group)
        tl = t.join(maybe_broadcast(lengths, small), kn)
    else:
        # no key: the distinct lengths are a handful of small integers
        # (bounded by the longest pattern), carried as a literal array
        lens = sorted(r["_len"] for r in lengths.collect())
        tl = t.select("*", F.explode(F.array(*[F.lit(x) for x in lens]).cast("array<int>")).alias("_len"))
    n_pos = F.length(text_col) - F.col("_len") + 1
    subs = F.when(n_pos >= 1,
                  F.array_distinct(F.transform(F.sequence(F.lit(1), n_pos),
                                               lambda i: F.substring(F.col(text_col), i, F.col("_len"))))
                  ).otherwise(F.array().cast("array<string>"))
    cut = tl.select("*", F.explode(subs).alias("_sub")).drop("_len")
    p = patterns.select("*", *[F.col(c).alias(k) for c, k in zip(pkeys, kn)],
                        F.col(pattern_col).alias("_sub"))
    same = [a for a, b in on if a == b]
    p = maybe_broadcast(p.drop(*same), small)
    out = cut.join(p, kn + ["_sub"])
    return out.drop(*kn, "_sub")
