"""Quality rules with host verdicts, in DataFrame functions only.

Each document is held against rules on its own text.  Failures are summed
per host (the ``source``), a host's failure rate is shrunk towards the rate
of all hosts by a beta prior fitted to the hosts (method of moments), and
the verdict on the host is joined back to its documents: on a bad host a
document that fails any rule goes, elsewhere only one that fails several.
A document that fails no rule stays wherever it comes from.

All rules of a document are computed in its row; only one narrow row per
document and one per host are moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import cut
from affinity.llm.text import WORD

MIN_WORDS = 50
MAX_REPEAT_PCT = 50          # base rule: share of words in repeated 3-word windows
SOFT_REPEAT_PCT = 30
SYMBOLS_PER_WORDS = 10       # a symbol per so many words is too many
MAX_DUP_LINES_PCT = 30
MEAN_WORD = (2, 12)          # mean word length allowed
BAD_HOST = 0.5               # shrunk failure rate from which a host is bad
TOLERATED = 1                # rules a document may fail on a host that is not bad

SYMBOL = r"[#*$%&|<>]"


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)


def _repeated_words(first: Column) -> Column:
    """Words covered by the windows at the sorted positions ``first``: three
    each, less what the next window covers too."""
    later = F.slice(first, 2, F.greatest(F.size(first), F.lit(1)))
    steps = F.zip_with(first, later, lambda x, y: F.least(y - x, F.lit(3)))
    return F.when(F.size(first) == 0, F.lit(0).cast("long")).otherwise(
        _sum(F.transform(steps, lambda x: F.coalesce(x, F.lit(3)).cast("long"))))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words per row of ``docs``; null text: zeros."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.select("doc_id", "source", t.alias("t"), F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("w"),
                    F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("w")
    grams = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.xxhash64(F.get(F.col("w"), i), F.get(F.col("w"), i + 1), F.get(F.col("w"), i + 2)).alias("h"),
        i.alias("i")))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    d = d.select("doc_id", "source", n.cast("long").alias("n_words"),
                 F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
                 F.regexp_count("t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
                 F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.sort_array(grams).alias("g"))
    # neighbours in hash order with the same hash are windows found twice
    g = F.col("g")
    twice = F.filter(g, lambda x, k: F.coalesce(F.get(g, k - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(g, k + 1)["h"] == x["h"], F.lit(False)))
    d = d.select("doc_id", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                 F.sort_array(F.transform(twice, lambda x: x["i"])).alias("first"))
    return d.select("doc_id", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                    _repeated_words(F.col("first")).alias("n_repeat_words"))


def judge(m: DataFrame) -> DataFrame:
    """Adds base_failed and n_failed (rules failed, the base one included)."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    soft = [
        100 * F.col("n_repeat_words") > SOFT_REPEAT_PCT * F.col("n_words"),
        F.col("n_symbols") * SYMBOLS_PER_WORDS > F.col("n_words"),
        100 * F.col("n_dup_lines") > MAX_DUP_LINES_PCT * F.col("n_lines"),
        (F.col("word_chars") < MEAN_WORD[0] * F.col("n_words")) | (F.col("word_chars") > MEAN_WORD[1] * F.col("n_words")),
    ]
    failed = base.cast("int")
    for s in soft:
        failed = failed + s.cast("int")
    return m.withColumn("base_failed", base).withColumn("n_failed", failed)


def host_verdicts(judged: DataFrame, bad_host: float = BAD_HOST) -> DataFrame:
    """Per source: source, host_rows, host_failed, host_rate (shrunk), host_bad.

    The prior is Beta(m s, (1 - m) s): m is the failure rate of all rows, and
    s makes the prior's variance that of the hosts' rates beyond what
    sampling gives.  Only three sums reach the driver."""
    h = cut(judged.groupBy("source").agg(F.count(F.lit(1)).alias("host_rows"),
                                         F.sum((F.col("n_failed") > 0).cast("long")).alias("host_failed")))
    rows, failed, hosts = h.agg(F.sum("host_rows"), F.sum("host_failed"), F.count(F.lit(1))).first()
    m = (failed or 0) / rows if rows else 0.0
    if 0 < m < 1:
        rate = F.col("host_failed") / F.col("host_rows")
        spread = h.agg(F.sum(F.col("host_rows") * (rate - m) * (rate - m)) / rows).first()[0]
        between = spread - m * (1 - m) * hosts / rows
        strength = min(1e6, max(1.0, m * (1 - m) / between - 1)) if between > 0 else 1e6
    else:
        strength = 1.0
    shrunk = (F.col("host_failed") + m * strength) / (F.col("host_rows") + strength)
    return h.withColumn("host_rate", shrunk).withColumn("host_bad", F.col("host_rate") > bad_host)


def quality_rules(docs: DataFrame, bad_host: float = BAD_HOST, tolerated: int = TOLERATED) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, then n_failed, host_rate, host_bad.

    Null and empty texts: no words, base rule failed.  Null source: a host of
    its own.  Repeated rows: judged each.  Empty table: no rows.  Columns
    other than doc_id, text and source are not read."""
    j = cut(judge(measures(docs)))
    h = host_verdicts(j, bad_host).select(F.col("source").alias("_s"), "host_rate", "host_bad")
    allowed = F.when(F.col("host_bad"), F.lit(0)).otherwise(F.lit(tolerated))
    return j.join(h, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("n_failed") <= allowed)).alias("kept"), "n_failed", "host_rate", "host_bad")
