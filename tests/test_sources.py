import os

import pytest

from affinity.sources import (normalize_id, read_delimited, read_partitioned, read_results, read_sections,
                              read_split_lines, union_all)
from conftest import write


def test_fixed_schema_positional_header_skipped(spark, scratch):
    p = write(os.path.join(scratch, "e.tsv"), "a\tb\tc\n01001\t01003\t120\n01001\t01001\t9\nx\ty\tbad\n")
    df = read_delimited(spark, p, "fips1 string, fips2 string, score bigint", sep="\t")
    rows = sorted(df.collect(), key=lambda r: r.fips1)
    assert [tuple(r) for r in rows] == [("01001", "01003", 120), ("01001", "01001", 9), ("x", "y", None)]


def test_failfast_raises_on_malformed(spark, scratch):
    p = write(os.path.join(scratch, "e.tsv"), "a\tb\tc\nx\ty\tbad\n")
    with pytest.raises(Exception):
        read_delimited(spark, p, "a string, b string, c bigint", mode="FAILFAST").collect()


def test_split_lines_trim_and_positions(spark, scratch):
    p = write(os.path.join(scratch, "series.txt"),
              "series_id\tarea_type\tarea\tmeasure\tseasonal\tsrd\ttitle\n"
              " LAUCN010010000000006 \tF\tCN0100100000000\t06\tU\t01\t Labor force: Autauga County, AL \n")
    df = read_split_lines(spark, p, {"sid": 0, "area_type": 1, "area_code": 2, "measure_code": 3,
                                     "srd": 5, "title": 6})
    rows = df.collect()
    assert len(rows) == 2  # header not skipped, as in a raw line scan
    data = [r for r in rows if r.sid != "series_id"][0]
    assert data.sid == "LAUCN010010000000006" and data.srd == "01"
    assert data.title == "Labor force: Autauga County, AL"
    df2 = read_split_lines(spark, p, {"sid": 0, "title": 6}, header="series_id")
    assert df2.count() == 1


def test_partitioned_read_is_union_all(spark, scratch):
    d = os.path.join(scratch, "data")
    os.makedirs(d)
    for i in range(3):
        write(os.path.join(d, f"values.{i}.txt"), "sid\tyear\tperiod\tvalue\tfootnotes\n"
              f" S{i} \t2010\tM13\t{i}.5\t\n S{i} \t2010\tM13\t{i}.5\t\n")
    df = read_partitioned(spark, os.path.join(d, "values.*"),
                          "sid string, year int, period string, value double, footnotes string", trim=["sid"])
    assert df.count() == 6  # duplicates kept
    assert sorted({r.sid for r in df.collect()}) == ["S0", "S1", "S2"]
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert sorted(tuple(r) for r in union_all([a, b]).collect()) == [(1, "x"), (2, "y")]


ADJ = ('"Autauga County, AL"\t01001\t"Autauga County, AL"\t01001\n'
       '\t\t"Chilton County, AL"\t01021\n'
       '\t\t"Elmore County, AL"\t01051\n'
       '"Baldwin County, AL"\t01003\t"Baldwin County, AL"\t01003\n'
       '\t\t"Clarke County, AL"\t01025\n'
       '"Barbour County, AL"\t01005\t"Bullock County, AL"\t01011\n')


def test_sectioned_adjacency(spark, scratch):
    p = write(os.path.join(scratch, "adj.txt"), ADJ)
    got = sorted(tuple(r) for r in read_sections(spark, p).collect())
    assert got == [("01001", "Autauga County, AL", "01021"), ("01001", "Autauga County, AL", "01051"),
                   ("01003", "Baldwin County, AL", "01025"), ("01005", "Barbour County, AL", "01011")]


RESULTS = (',votes_dem,votes_gop,total_votes,per_dem,per_gop,diff,per_point_diff,state_abbr,county_name,combined_fips\n'
           '0,93003.0,130413.0,246588.0,0.377,0.529,"37,410",15.17%,AK,Alaska,2013\n'
           '1,5908.0,18409.0,24661.0,0.239,0.746,"12,501",50.69%,AL,Autauga County,1001\n'
           '2,1000000.0,2234567.0,3234567.0,0.309,0.691,"1,234,567",38.17%,CA,Big County,6001\n'
           '3,4.0,900.0,904.0,0.004,0.996,896,99.12%,AL,Small County,1003\n'
           '4,10.0,2.0,12.0,0.833,0.167,"-1,234",-3.5%,HI,Hawaii County,15001\n')


def test_results_rows_all_arities(spark, scratch):
    p = write(os.path.join(scratch, "res.csv"), RESULTS)
    got = {r.line_num: r for r in read_results(spark, p).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]  # header dropped
    assert got[0].diff == 37410 and got[0].per_pt_diff == 15.17 and got[0].d_votes == 93003
    assert got[2].diff == 1234567 and got[2].total_votes == 3234567
    assert got[3].diff == 896 and got[3].per_pt_diff == 99.12
    assert got[4].diff == -1234 and got[4].per_pt_diff == -3.5  # negative groups parse right
    assert got[1].fips == "1001" and got[1].county == "Autauga County"
    kept = read_results(spark, p, exclude_states=("AK", "HI")).collect()
    assert sorted(r.state for r in kept) == ["AL", "AL", "CA"]


def test_normalize_id(spark):
    df = spark.createDataFrame([("1001",), (" 01001",), ("01001",)], "id string")
    assert {r[0] for r in df.select(normalize_id("id")).collect()} == {"01001"}
    # the trap: numeric coercion would match, text comparison does not
    assert spark.sql("select '01001' = '1001'").first()[0] is False


def test_longer_ids_stay_whole(spark):
    ids = [("01001020100",), ("01001020200",), ("1001",), ("01001\r",)]
    df = spark.createDataFrame(ids, "id string")
    assert [r[0] for r in df.select(normalize_id("id")).collect()] == ["01001020100", "01001020200", "01001", "01001"]


def test_crlf_files(spark, scratch):
    def crlf(name, text):
        p = os.path.join(scratch, name)
        with open(p, "w", encoding="utf-8", newline="") as f:
            f.write(text.replace("\n", "\r\n"))
        return p
    adj = sorted(tuple(r) for r in read_sections(spark, crlf("adj.txt", ADJ)).collect())
    assert adj == [("01001", "Autauga County, AL", "01021"), ("01001", "Autauga County, AL", "01051"),
                   ("01003", "Baldwin County, AL", "01025"), ("01005", "Barbour County, AL", "01011")]
    rows = read_split_lines(spark, crlf("s.txt", "series_id\ttitle\nS1 \t x y \n"), {"sid": 0, "title": 1}, header="series_id")
    assert [tuple(r) for r in rows.collect()] == [("S1", "x y")]
    got = {r.line_num: r for r in read_results(spark, crlf("res.csv", RESULTS)).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4] and got[0].fips == "2013" and got[2].diff == 1234567
