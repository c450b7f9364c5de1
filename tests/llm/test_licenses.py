import re
import string

from conftest import SF01
from llm_cases import DOCS, ODD, with_clashes

from affinity.llm import licenses

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def base(text):
    w = re.findall(licenses.LICENSE_WORD, (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def check(rows, got):
    assert sorted(str((i, *base(t))) for i, t in rows) == sorted(
        str((g.doc_id, g.n_words, g.n_base, g.first_word, g.last_word, g.base_labels)) for g in got)
    for g in got:
        assert 0 <= g.score <= 1
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(","))
        assert (g.score > 0) == bool(g.labels)


def test_whole_table(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    got = licenses.scan_licenses(d).collect()
    check([(r.doc_id, r.text) for r in d.collect()], got)
    assert sum(g.n_base for g in got) > 0


def test_places_and_passages(spark):
    mit = licenses.PASSAGES[0][0].split()
    worn = " ".join(mit[:8] + ["really"] + mit[8:15] + mit[16:])     # a word put in, one left out
    rows = [(1, "GNU  General-Public\nLicense, gnu general public license"), (2, "the MIT License; mit license mit"),
            (3, "cc by cc by cc"), (4, "gnu general license public"), (5, "x " * 30 + worn + " y" * 30),
            (6, " ".join(mit[:9])), (7, "ApacÅe License K"), (8, "apache2license mité license"), (9, "a"),
            (10, "MITLICENSE mit_license cc/by")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {g.doc_id: g for g in licenses.scan_licenses(d).collect()}
    check(rows, list(got.values()))
    assert got[5].labels == "mit" and got[5].base_labels == "" and 0.6 <= got[5].score < 1
    assert got[6].labels == "" and got[2].n_base == 2 and got[3].n_base == 2


def test_odd_rows(spark):
    d = spark.createDataFrame(ODD, DOCS)
    check([(r[0], r[1]) for r in ODD], licenses.scan_licenses(with_clashes(d)).collect())
    assert licenses.scan_licenses(d.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    d = spark.read.parquet(f"{SF01}/documents.parquet")
    plan = licenses.scan_licenses(d)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan


def test_names_of_any_version_and_short_texts(spark):
    """Names stand whole, so a word put in before them or another version
    number loses none; they are no base places."""
    rows = [(1, "licensed under cc by sa 3 0"), (2, "Licensed under a CC-BY-NC 4.0"), (3, "the GNU Lesser General Public License v2.1"),
            (4, "GNU Affero General Public License"), (5, "Eclipse Public License 2.0"), (6, "cc by-nd, CC0 1.0"),
            (7, "this is free and unencumbered software released into the public domain"), (8, "public license eclipse")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {g.doc_id: g for g in licenses.scan_licenses(d).collect()}
    check(rows, list(got.values()))
    assert {i: got[i].labels for i in got} == {1: "cc-by,cc-by-sa", 2: "cc-by,cc-by-nc", 3: "lgpl", 4: "agpl", 5: "epl",
                                               6: "cc-by,cc-by-nd,cc0", 7: "unlicense", 8: ""}
    assert [got[i].n_base for i in (1, 3, 6)] == [1, 0, 1]
