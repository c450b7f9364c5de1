import re

from conftest import SF01
from llm_cases import DOCS, ODD, with_clashes

import corpus_pipeline as C

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_by_one(spark, scratch):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select(*COLUMNS)
    texts = {r.doc_id: r.text for r in docs.collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    seen = []
    for k, (name, stage) in enumerate(C.STAGES):
        stage(spark, docs, SF01).write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        if k < 4:
            assert docs.columns == COLUMNS
        seen.append([tuple(r) for r in docs.collect()])
    good, one, cut, mix, tok = seen
    # quality: good documents stay, bad ones go
    kept = {r[0] for r in good}
    assert sum(label[i] == 1 and i not in kept for i in label) <= 0.02 * len(label)
    assert sum(label[i] == 0 and i in kept for i in label) <= 0.1 * sum(v == 0 for v in label.values())
    # near duplicates: the least doc_id of each group, texts as they were
    assert {r[0] for r in one} < kept and all(texts[r[0]] == r[1] for r in one)
    assert len({r[1] for r in one}) == len(one)
    # repeated passages: no window of 20 words is left that was there earlier
    assert [r[0] for r in sorted(cut)] == [r[0] for r in sorted(one)]
    windows = set()
    for r in sorted(cut):
        if r[1] == texts[r[0]]:
            w = re.findall(r"[^\x20\x09-\x0D]+", r[1])
            mine = {tuple(w[i:i + 20]) for i in range(len(w) - 19)}
            assert not mine & windows
            windows |= mine
        else:
            assert r[4] == len(r[1])
    # mixture: rows of the stage before, none more than three times
    assert {r[:2] for r in mix} <= {r[:2] for r in cut}
    assert max(sum(m[0] == i for m in mix) for i in {m[0] for m in mix}) <= 3
    # tokens: a row for each
    assert sorted(r[0] for r in tok) == sorted(r[0] for r in mix)
    assert C.run(spark, SF01).count() == len(tok)


def test_odd_rows_pass_every_stage(spark, scratch):
    docs = with_clashes(spark.createDataFrame(ODD, DOCS))
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF01)
        if k < 4:
            assert out.columns == docs.columns
            out.write.parquet(f"{scratch}/{k}")
            docs = spark.read.parquet(f"{scratch}/{k}")
    assert out.columns[0] == "doc_id"
    for name, stage in C.STAGES:
        assert stage(spark, docs.limit(0), SF01).count() == 0


def test_columns_named_like_the_operators_own_stay(spark):
    """Whatever the case of their names, further columns come out as they went in."""
    docs = spark.createDataFrame(ODD, DOCS).selectExpr("*", "'mine' AS N_Words", "'mine' AS n_removed", "'mine' AS Kept_Text", "'mine' AS rest",
                                                       "'mine' AS chunk", "'mine' AS bytes")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF01)
        assert out.columns == docs.columns
        assert {r[c] for r in out.collect() for c in docs.columns[5:]} <= {"mine"}
    assert C.STAGES[-1][1](spark, docs, SF01).count() == docs.count()
