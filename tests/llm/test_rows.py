"""Row numbers have to mean the same row in every pass, also where executors
come or go between two of them."""

from contextlib import contextmanager

import pytest
from llm_cases import rows_of

from affinity.llm import ann, jaccard, mixing

SPLITS = ("spark.sql.files.minPartitionNum", "spark.sql.leafNodeDefaultParallelism")


@pytest.fixture()
def cores(spark):
    """cores(n): from now on, n cores are alive for the planner."""
    conf = spark.sparkContext._jsc.sc().conf()

    @contextmanager
    def alive(n):
        conf.set("spark.default.parallelism", str(n))
        assert spark.sparkContext.defaultParallelism == n
        try:
            yield
        finally:
            conf.remove("spark.default.parallelism")
    before = {k: spark.conf.get(k, None) for k in SPLITS}
    for k in SPLITS:
        spark.conf.unset(k)
    yield alive
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def many_files(spark, scratch, rows, schema):
    """``rows`` in eight files."""
    spark.createDataFrame(rows, schema).repartitionByRange(8, schema.split(" ")[0]).write.parquet(f"{scratch}/in")
    return spark.read.parquet(f"{scratch}/in")


def both(cores, build):
    with cores(4):
        want = rows_of(build())
        late = build()
    with cores(2):
        return want, rows_of(late)


def test_documents(spark, scratch, cores):
    rows = [(i, " ".join(f"w{i // 2}x{j}" for j in range(30)), f"s{i % 3}") for i in range(200)]
    docs = many_files(spark, scratch, rows, "doc_id long, text string, source string")
    with cores(4):
        four = docs.rdd.getNumPartitions()
    with cores(2):
        assert docs.select("*").rdd.getNumPartitions() < four
    want, got = both(cores, lambda: jaccard.keep_one(docs))
    assert got == want == sorted(((i, t, s) for i, t, s in rows if i % 2 == 0), key=str)
    want, got = both(cores, lambda: mixing.mixed_documents(docs))
    assert got == want and got


def test_vectors(spark, scratch, cores):
    rows = [(i, [float((i * 7 + j * j) % 23 - 11) for j in range(8)]) for i in range(300)]
    vectors = many_files(spark, scratch, rows, "vec_id long, embedding array<double>")
    want, got = both(cores, lambda: ann.search(vectors, "vec_id % 20 = 0", k=5))
    assert got == want and got


def test_powers_hold_what_was_asked_for():
    """Doubling held up to twice the powers in every worker."""
    from affinity.llm import text as T
    p = T._Powers(T._WORD_BASE)
    n = (1 << 17) + 1
    up, down = p.to(n)
    assert len(up) == len(down) == n and len(p.up) <= n + T.POWERS_STEP
    assert [int(x) for x in up[:3]] == [pow(int(p.base), k, 1 << 64) for k in range(3)]
    assert (up * down == 1).all()
