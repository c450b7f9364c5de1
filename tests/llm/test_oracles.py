"""The registered queries against their DuckDB statements."""

import math

import duckdb
import pytest
from conftest import SF001
from llm_cases import DOCS, ODD

from affinity.llm.oracles import ORACLES
from affinity.llm.queries import QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, name, root):
    df = QUERIES[name](spark, root)
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet*/*.parquet')" if root != SF001
                    else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    rel = con.sql(ORACLES[name])
    cols = rel.columns
    assert sorted(cols) == sorted(df.columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(cols, map(str, rel.types)))

    def norm(rows):
        return sorted((tuple(round(x, 9) if isinstance(x, float) and math.isfinite(x) else x for x in r) for r in rows), key=str)
    assert norm(tuple(r[c] for c in cols) for r in df.collect()) == norm(rel.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    compare(spark, name, SF001)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql_on_odd_rows(spark, name, scratch):
    docs = [(i, t, *rest) for i, t, *rest in ODD]
    docs += [(7000 + i, " ".join(f"w{j % (40 + i)}" for j in range(200)), "en", "s3", 0) for i in range(6)]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{scratch}/documents.parquet")
    pages = [(1, "u", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "u", None), (4, "u", ""), (None, None, "<p>é</p>"), (5, "v", "5"), (5, "v", "5")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{scratch}/pages.parquet")
    vectors = [(100 * i, [0.5 * i, -1.0, 0.25]) for i in range(14)] + [(7, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (100, [0.0, 0.0, 0.0]),
               (300, None), (400, []), (500, [1.0, None, 2.0]), (600, [float("nan")] * 3), (700, [1.0]), (None, [1.0] * 3)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{scratch}/embeddings.parquet")
    compare(spark, name, scratch)


def test_every_operator_is_registered_once():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14))
