import hashlib
import random
import re

from conftest import SF001
from llm_cases import DOCS, ODD, rows_of, with_clashes

from affinity.llm import substring


def brute(rows, n=20):
    """Every window, its least id, and the words its later ones cover."""
    last = 1 << 62
    least, words = {}, [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - n + 1):
            g = tuple(w[k:k + n])
            least[g] = min(least.get(g, last), last if i is None else i)
    out = []
    for (i, _), w in zip(rows, words):
        keep, seen = [True] * len(w), set()
        for k in range(len(w) - n + 1):
            g = tuple(w[k:k + n])
            if g in seen or least[g] < (last if i is None else i):
                keep[k:k + n] = [False] * n
            seen.add(g)
        kept = " ".join(x for x, y in zip(w, keep) if y)
        out.append((i, len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_cover_has_a_shift_for_all_remainders():
    m = substring.PERIOD
    for i in range(m):
        for j in range(m):
            assert any((i + s) % m in substring.COVER and (j + s) % m in substring.COVER for s in range(m))


def test_whole_table(spark):
    d = spark.read.parquet(f"{SF001}/documents.parquet")
    assert rows_of(substring.substring_dedup(d)) == brute([(r.doc_id, r.text) for r in d.collect()])


def test_random_passages(spark):
    rng = random.Random(1)
    base = [[rng.choice("abcdefg") for _ in range(400)] for _ in range(5)]
    rows = []
    for i in range(200):
        b, s = rng.choice(base), rng.randrange(300)
        rows.append((i * 7 % 211, " ".join(rng.choice("hijk") for _ in range(rng.randrange(30))) + " \n"
                     + " ".join(b[s:s + rng.randrange(5, 90)]) + " x y " + "\t".join(b[s:s + rng.randrange(60)])))
    rows += [(None, " ".join(base[0])), (None, " ".join(base[0])), (5, " ".join(base[0])), (402, "a " * 100), (402, "a " * 100)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert sum(r[2] for r in want) > 1000
    assert rows_of(substring.substring_dedup(d)) == want
    assert rows_of(substring.substring_dedup(d.repartition(7))) == want


def test_odd_rows(spark):
    d = spark.createDataFrame(ODD, DOCS)
    assert rows_of(substring.substring_dedup(d)) == brute([(r[0], r[1]) for r in ODD])
    out = substring.remove_repeats(with_clashes(d).withColumn("n_words", d.n_chars))
    assert [c for c in out.columns][-3:] == ["n_words", "n_removed", "kept_text"]
    assert out.count() == len(ODD)
    assert substring.substring_dedup(d.limit(0)).count() == 0


def test_blocks_of_rows_give_the_windows_of_the_whole(monkeypatch):
    """Arrays are made for runs of rows, never for all words of a chunk."""
    import numpy as np
    import pyarrow as pa
    from affinity.llm import packing as P
    from affinity.llm import substring as S
    rnd = np.random.default_rng(3)
    base = [" ".join(f"w{x}" for x in rnd.integers(0, 30, int(k))) for k in rnd.integers(0, 90, 40)]
    texts = pa.chunked_array([pa.array(base[:13] + [None, ""]), pa.array([], pa.string()), pa.array(base[13:] + base[5:9])])
    ids = np.arange(len(texts))

    def found():
        c = S.Chunk(texts, ids)
        at, h = c.anchors()
        _, which, n = P.groups(h)
        return [at, h, *c.candidates(at[(n > 1)[which]])]
    whole = found()
    assert len(whole[2]) > 50
    sizes, grams = [], S.T.Grams
    monkeypatch.setattr(S.T, "Grams", lambda words: sizes.append(len(words)) or grams(words))
    monkeypatch.setattr(S, "BLOCK_WORDS", 100)
    for a, b in zip(whole, found(), strict=True):
        assert a.dtype == b.dtype and (a == b).all()
    assert max(sizes) <= 100 and sum(sizes) > 1000
