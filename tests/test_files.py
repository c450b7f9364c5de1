"""Every registered query over inputs read from the original file formats."""

import dataclasses
import os

import pytest

from affinity.plans import catalog
from affinity.plans.files import FileInputs, FilePaths
from affinity.plans.params import REFERENCE
from conftest import write

COUNTIES = [  # fips, county, state, lat, lon, never..always, dem share
    ("01001", "Autauga County", "AL", 32.5, -86.6, (0.05, 0.1, 0.2, 0.3, 0.35), 0.24),
    ("01003", "Baldwin County", "AL", 30.7, -87.7, (0.2, 0.2, 0.2, 0.2, 0.2), 0.19),
    ("01005", "Barbour County", "AL", 31.9, -85.4, (0.01, 0.04, 0.1, 0.25, 0.6), 0.47),
    ("13001", "Appling County", "GA", 31.7, -82.3, (0.3, 0.2, 0.1, 0.2, 0.2), 0.21),
    ("13003", "Atkinson County", "GA", 31.3, -82.9, (0.0, 0.05, 0.15, 0.3, 0.5), 0.28),
    ("13005", "Bacon County", "GA", None, None, (0.1, 0.1, 0.1, 0.3, 0.4), 0.15),
    ("02013", "Aleutians East Borough", "AK", 55.4, -161.9, (0.1, 0.1, 0.2, 0.3, 0.3), 0.38),
]
FIPS = [c[0] for c in COUNTIES]


def score(a, b):
    if a == b:
        return 900000
    same = a[:2] == b[:2]
    return (50000 if same else 3000) + (int(a) % 97) * 10 + (int(b) % 89)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("files"))
    p = lambda n: os.path.join(d, n)
    write(p("pairs.tsv"), "a\tb\tscore\n"
          + "".join(f"{a}\t{b}\t{score(a, b)}\n" for a in FIPS for b in FIPS))
    write(p("centers.csv"), "fips,clon10,clat10,pclon10,pclat10,name\n" + "".join(
        f"{f},{'NA' if lat is None else lon},{'NA' if lat is None else lat},"
        f"{'NA' if lat is None else lon + 0.1},{'NA' if lat is None else lat - 0.1},{n}\n"
        for f, n, _, lat, lon, _, _ in COUNTIES))
    write(p("attitudes.csv"), "COUNTYFP,NEVER,RARELY,SOMETIMES,FREQUENTLY,ALWAYS\n" + "".join(
        f"{int(f)},{','.join(str(x) for x in sh)}\n" for f, _, _, _, _, sh, _ in COUNTIES))
    rows = [",votes_dem,votes_gop,total_votes,per_dem,per_gop,diff,per_point_diff,state_abbr,county_name,combined_fips"]
    for i, (f, n, st, _, _, _, dem) in enumerate(COUNTIES):
        tot = 20000 + 3000 * i
        dv = round(tot * dem)
        rv = tot - dv
        diff = abs(rv - dv)
        rows.append(f"{i},{dv}.0,{rv}.0,{tot}.0,{dem},{1 - dem},\"{diff:,}\",{diff / tot * 100:.2f}%,{st},{n},{int(f)}")
    write(p("results.csv"), "\n".join(rows) + "\n")
    series, data = ["series_id\tarea_type_code\tarea_code\tmeasure_code\tseasonal\tsrd_code\tseries_title"], {}
    for i, (f, n, st, _, _, _, _) in enumerate(COUNTIES):
        srd = f[:2]
        for m, label, val in (("06", "Labor force", 10000 + 1000 * i), ("03", "Unemployment Rate", 4.0 + i)):
            sid = f"LAUCN{f}0000000{m}"
            series.append(f"{sid}\tF\tCN{f}00000000\t{m}\tU\t{srd}\t{label}: {n}, {st}")
            data.setdefault(srd, []).append(f"{sid}     \t2010\tM13\t{val}\t")
            data[srd].append(f"{sid}     \t2009\tM13\t{val + 1}\t")
    write(p("series.txt"), "\n".join(series) + "\n")
    os.makedirs(p("data"))
    for srd, lines in data.items():
        write(os.path.join(p("data"), f"values.{srd}.txt"),
              "series_id\tyear\tperiod\tvalue\tfootnote_codes\n" + "\n".join(lines) + "\n")
    write(p("srd.txt"), "srd_code\tsrd_text\n01\tAlabama\n13\tGeorgia\n02\tAlaska\n")
    write(p("states.txt"), "fullState\tst\nAlabama\tAL\nGeorgia\tGA\nAlaska\tAK\n")
    write(p("adj.txt"), '"Autauga County, AL"\t01001\t"Autauga County, AL"\t01001\n'
          '\t\t"Barbour County, AL"\t01005\n'
          '"Appling County, GA"\t13001\t"Atkinson County, GA"\t13003\n')
    paths = FilePaths(edges=p("pairs.tsv"), centers=p("centers.csv"), attitudes=p("attitudes.csv"),
                      results=p("results.csv"), series_dictionary=p("series.txt"),
                      series_values=os.path.join(p("data"), "values.*"), region_states=p("srd.txt"),
                      state_names=p("states.txt"), adjacency=p("adj.txt"))
    params = dataclasses.replace(REFERENCE, fanout_unit="01001", attitude_threshold=0.4)
    return FileInputs(spark, paths, params=params)


def test_file_inputs_relations(inputs):
    assert inputs.edges.count() == 7 * 6
    lv = {r.unit: r.level for r in inputs.level.collect()}
    assert lv == {"01001": 10000.0, "01003": 11000.0, "01005": 12000.0, "13001": 13000.0,
                  "13003": 14000.0, "13005": 15000.0}  # AK excluded with its results row
    names = {r.unit: r.grp for r in inputs.names.collect()}
    assert names["01001"] == "Alabama" and "02013" not in names
    coords = {r.unit: (r.lat, r.lon) for r in inputs.coords.collect()}
    assert coords["13005"] == (None, None) and coords["01001"] == (32.5, -86.6)
    res = {r.unit: r.result for r in inputs.results.collect()}
    assert res["01005"] == 0.47


@pytest.mark.parametrize("name", catalog.names())
def test_every_query_runs_on_file_inputs(inputs, name):
    df = catalog.run(name, inputs)
    rows = df.collect()
    assert df.columns and isinstance(rows, list)


def test_file_values(inputs):
    avg = {r.unit: r.avg_score for r in catalog.run("avg_connectivity", inputs).collect()}
    want = sum(score("01001", b) for b in FIPS if b != "01001") / 6
    assert abs(avg["01001"] - want) < 1e-9
    fan = catalog.run("one_unit_fanout", inputs).collect()
    assert sorted(r.u2 for r in fan) == ["01003", "01005", "13001", "13003"]  # in box, coords known
    adj = sorted(tuple(r) for r in catalog.run("adjacency_neighbors", inputs).collect())
    assert adj == [("01001", "Autauga County, AL", "01005"), ("13001", "Appling County, GA", "13003")]
    parsed = {r.fips: r for r in catalog.run("parse_results_rows", inputs).collect()}
    assert len(parsed) == 7 and "2013" not in {r.fips for r in catalog.run("exclude_groups", inputs).collect()}
    be = {r.unit: r for r in catalog.run("border_effect", inputs).collect()}
    assert be["01001"].avg_same > be["01001"].avg_cross


def test_both_input_kinds_satisfy_the_interface(spark, inputs):
    from affinity.plans.binding import Binding
    from affinity.plans.inputs import Inputs
    from conftest import SF001
    assert isinstance(inputs, Inputs)
    assert isinstance(Binding(spark, SF001, keep=False), Inputs)


def test_command_line_on_file_inputs(spark, inputs, tmp_path):
    import json
    from affinity.__main__ import main
    cfg = tmp_path / "paths.json"
    cfg.write_text(json.dumps(dataclasses.asdict(inputs.paths)))
    out = str(tmp_path / "out")
    assert main(["--files", str(cfg), "--out", out, "avg_connectivity", "level_by_unit"]) == 0
    assert spark.read.parquet(f"{out}/avg_connectivity").count() == 7
    assert spark.read.parquet(f"{out}/level_by_unit").count() == 6


def test_command_line_parameters(spark, inputs, tmp_path):
    import json
    from affinity.__main__ import main
    cfg = tmp_path / "paths.json"
    cfg.write_text(json.dumps(dataclasses.asdict(inputs.paths)))
    out = str(tmp_path / "out")
    assert main(["--files", str(cfg), "--param", 'fanout_unit="01003"', "--param", "level_year=2009",
                 "--out", out, "one_unit_fanout", "level_by_unit"]) == 0
    fan = spark.read.parquet(f"{out}/one_unit_fanout").collect()
    assert sorted(r.u2 for r in fan) == ["01001", "01005", "13001", "13003"]
    lv = {r.unit: r.level for r in spark.read.parquet(f"{out}/level_by_unit").collect()}
    assert lv["01001"] == 10001.0  # the 2009 values


def test_fanout_without_unit_is_an_error(spark, inputs):
    from affinity.plans import catalog
    from affinity.plans.files import FileInputs
    bare = FileInputs(spark, inputs.paths)  # original defaults: no fan-out unit
    with pytest.raises(ValueError):
        catalog.run("one_unit_fanout", bare)
