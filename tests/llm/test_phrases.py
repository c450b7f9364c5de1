import re
from collections import Counter

import numpy as np
from llm_cases import DOCS, ODD, with_clashes

from affinity.llm import phrases


def brute(rows, least, most=5, pct=100, top=2000):
    """Collocations of (lang, text) rows from plain counters."""
    words, counts = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            counts.update((lang, tuple(w[i:i + k])) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    found = {p: f for p, f in counts.items() if len(p[1]) > 1 and f >= least}
    gone = set()
    for (lang, p), f in found.items():
        for size in range(2, len(p)):
            gone |= {(lang, p[i:i + size]) for i in range(len(p) - size + 1) if 100 * f >= pct * counts[lang, p[i:i + size]]}
    out = {}
    for (lang, p), a in found.items():
        if (lang, p) not in gone:
            n = words[lang]
            score, _, l, r = min((1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]])
                                 for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r, n))
    return sorted((lang, i, p.decode(), -a, l, r, n, -s) for lang, found in out.items()
                  for i, (s, a, p, l, r, n) in enumerate(sorted(found)[:top], 1))


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def corpus(seed, docs=60, words=200):
    """Texts of a skewed vocabulary with set phrases, in two languages."""
    rng = np.random.default_rng(seed)
    fixed = ["New York City hall", "as soon as possible", "É né à", "of of of of of of", "x"]
    rows = []
    for i in range(docs):
        parts = [f"w{int(v)}" for v in rng.zipf(1.4, words) if v < 400]
        for at in rng.integers(0, len(parts), 25):
            parts.insert(int(at), fixed[int(rng.integers(len(fixed)))])
        text = "".join(p + [" ", "  ", "\t", ", ", ". ", "\n", "; "][int(rng.choice(7, p=[.7, .05, .05, .05, .05, .05, .05]))] for p in parts)
        rows.append((["en", "de", None, "und"][i % 4], text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], DOCS)


def test_against_counters(spark):
    rows = corpus(1) + [(lang, t) for _, t, lang, _, _ in ODD]
    d = with_clashes(frame(spark, rows))
    for c in ("block", "word", "code", "a", "b", "f", "rank", "phrase", "cut"):
        d = d.selectExpr("*", f"'clash' AS {c}")
    want = brute(rows, 30)
    assert len(want) > 50 and max(len(r[2].split(" ")) for r in want) == 5
    assert got(phrases.collocations(d, min_count=30)) == want


def test_blocks_tiles_and_parameters_do_not_change_counts(spark, monkeypatch):
    rows = corpus(2)
    for block, tile, dense in ((4000, 4, 3), (1, 8, 1), (1 << 20, 1024, 1 << 16)):
        monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
        monkeypatch.setattr(phrases, "TILE", tile)
        monkeypatch.setattr(phrases, "DENSE", dense)
        d = frame(spark, rows).repartition(3)
        assert got(phrases.collocations(d, min_count=25, max_words=4, covered_pct=60, top=40)) == brute(rows, 25, 4, 60, 40)


def test_repeats_overlaps_and_pieces(spark):
    rows = [("en", "a a a a. A a,a a")] * 5 + [("en", "b c")] * 5 + [("de", "b. c b, c")] * 9 + [("en", ""), ("en", None), ("fr", " . , ")]
    want = brute(rows, 5)
    assert ("en", 1, "b c", 5, 5, 5, 50, 10000) in want and not any(r[0] == "fr" for r in want)
    assert got(phrases.collocations(frame(spark, rows), min_count=5)) == want


def test_nothing_frequent_and_empty_table(spark):
    d = frame(spark, [("en", "one two three"), (None, None)])
    assert got(phrases.collocations(d)) == []
    assert got(phrases.collocations(d.limit(0))) == []


def test_pairs_in_tiles():
    rng = np.random.default_rng(5)
    seq = np.minimum(rng.zipf(1.3, 300_000) - 1, 5000).astype(np.int32)
    seq[rng.random(len(seq)) < 0.1] = -1
    a, b, n = phrases.count_pairs(seq, 5001)
    want = Counter((x, y) for x, y in zip(seq[:-1].tolist(), seq[1:].tolist()) if x >= 0 and y >= 0)
    assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == dict(want) and len(a) == len(want)
    # some are counted in place, some as coordinates
    held = np.bincount(seq[seq >= 0] // phrases.TILE)
    assert held[0] > phrases.DENSE and (a >= phrases.TILE).any()
