"""Inputs read from the original analysis' file formats.

A user of the original program points :class:`FilePaths` at the same files
and gets the relations every registered query needs, under the same
attribute names as the test-table binding:

=====================  ====================================================
edges                  tab file ``fips1, fips2, score`` (header), self pairs
                       removed on load
coords / pair_coords   centers CSV (header): ``clat10/clon10`` for maps,
                       ``pclat10/pclon10`` (population centres) for distances;
                       text read as strings, then ``try_cast``
attitudes              comma file ``unit, never, rarely, sometimes, freq,
                       always`` (header)
results / names        result rows with quoted thousands (groups in
                       ``excluded_groups`` dropped) joined to the state
                       name table: unit -> (county name, full state)
series                 all series value files in one scan (tab, header)
dictionary             series dictionary lines, tab-split and trimmed
region_names           ``srd -> state`` table (tab, header)
adjacency              sectioned adjacency text
=====================  ====================================================

All unit ids are stripped and padded with zeros to at least five characters
on load; longer ids stay whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.numeric import to_double
from affinity.operators.communities import merge_tree
from affinity.operators.edges import drop_self_pairs
from affinity.operators.pairs import wide_units
from affinity.operators.sizing import is_small
from affinity.operators.units import MEASURE_LEVEL, MEASURE_RATE, SHARES, level_by_unit
from affinity.plans.params import REFERENCE, Params
from affinity.sources import (malformed_lines, malformed_results, normalize_id, read_delimited, read_partitioned, read_results, read_sections,
                              read_split_lines, union_all)

EDGE_SCHEMA = "fips1 string, fips2 string, score bigint"
ATTITUDE_SCHEMA = "unit string, " + ", ".join(f"{s} double" for s in SHARES)
SERIES_SCHEMA = "sid string, year int, period string, value double, notes string"
# first field of the header row of the series dictionary file
DICTIONARY_HEADER = "series_id"
SERIES_FIELDS = {"sid": 0, "area_type": 1, "area_code": 2, "measure_code": 3, "srd": 5, "title": 6}


@dataclass(frozen=True)
class FilePaths:
    edges: str
    centers: str
    attitudes: str
    results: str
    series_dictionary: str
    series_values: str            # a glob over the series value files, or one folder
    region_states: str            # srd -> state name
    state_names: str              # full state name -> abbreviation
    adjacency: str | None = None


class FileInputs:
    def __init__(self, spark: SparkSession, paths: FilePaths, params: Params = REFERENCE, id_width: int = 5,
                 keep: bool = True):
        self.spark = spark
        self.paths = paths
        self.params = params
        self.id_width = id_width
        self.keep = keep

    def _keep(self, df: DataFrame) -> DataFrame:
        return df.persist(StorageLevel.MEMORY_AND_DISK) if self.keep else df

    def release(self) -> None:
        """Unpersist every kept relation."""
        for name in ("raw_index", "coords", "pair_coords", "units_wide", "attitudes", "results", "names", "level", "rate"):
            if name in self.__dict__:
                self.__dict__[name].unpersist()
                del self.__dict__[name]
        self.__dict__.pop("edges", None)
        self.__dict__.pop("merge_tree", None)

    @cached_property
    def small_units(self) -> bool:
        """Whether unit tables may be broadcast: known from the size of the
        centers file, without a job."""
        return is_small(self._centers)

    def _id(self, col: str):
        return normalize_id(col, self.id_width)

    # ----------------------------------------------------------- edges
    @cached_property
    def raw_index(self) -> DataFrame:
        e = read_delimited(self.spark, self.paths.edges, EDGE_SCHEMA, sep="\t")
        return self._keep(e.select(self._id("fips1").alias("u1"), self._id("fips2").alias("u2"),
                                   F.col("score").alias("w")))

    @cached_property
    def edges(self) -> DataFrame:
        return drop_self_pairs(self.raw_index)

    @cached_property
    def merge_tree(self) -> DataFrame:
        """Mergers of the communities: one row each, in the shared folder."""
        return merge_tree(self.edges)

    def text_edges(self) -> DataFrame:
        return self.edges

    # ----------------------------------------------------------- units
    @cached_property
    def _centers(self) -> DataFrame:
        # header names bind the columns; everything is read as text
        return self.spark.read.option("header", True).csv(self.paths.centers)

    @cached_property
    def coords(self) -> DataFrame:
        c = self._centers
        return self._keep(c.select(self._id("fips").alias("unit"), to_double("clat10").alias("lat"),
                                   to_double("clon10").alias("lon")))

    @cached_property
    def pair_coords(self) -> DataFrame:
        c = self._centers
        return self._keep(c.select(self._id("fips").alias("unit"), to_double("pclat10").alias("lat"),
                                   to_double("pclon10").alias("lon")))

    @cached_property
    def units_wide(self) -> DataFrame:
        return self._keep(wide_units(self.pair_coords, self.rate, self.results, self.attitudes))

    @cached_property
    def attitudes(self) -> DataFrame:
        m = read_delimited(self.spark, self.paths.attitudes, ATTITUDE_SCHEMA, sep=",")
        return self._keep(m.select(self._id("unit").alias("unit"), *SHARES))

    def parsed_results(self, exclude: tuple = ()) -> DataFrame:
        return read_results(self.spark, self.paths.results, exclude_states=exclude)

    @cached_property
    def _results_rows(self) -> DataFrame:
        return self.parsed_results(self.params.excluded_groups)

    @cached_property
    def results(self) -> DataFrame:
        return self._keep(self._results_rows.select(self._id("fips").alias("unit"),
                                                    F.col("per_dem").alias("result")))

    @cached_property
    def names(self) -> DataFrame:
        st = read_delimited(self.spark, self.paths.state_names, "full_state string, st string", sep="\t")
        r = self._results_rows
        return self._keep(r.join(st, r.state == st.st).select(
            self._id("fips").alias("unit"), F.col("county").alias("name"), F.col("full_state").alias("grp")))

    @cached_property
    def region_names(self) -> DataFrame:
        return read_delimited(self.spark, self.paths.region_states, "srd string, state string", sep="\t")

    # ---------------------------------------------------------- series
    @cached_property
    def series(self) -> DataFrame:
        """All series files, not kept: the analyses filter them on the scan."""
        return read_partitioned(self.spark, self.paths.series_values, SERIES_SCHEMA, sep="\t",
                                trim=["sid"]).drop("notes")

    def malformed(self) -> DataFrame:
        """Lines that do not parse, of the edge file and of the result file."""
        text = read_delimited(self.spark, self.paths.edges, "a string, b string, c string", sep="\t")
        edges = text.select(F.concat_ws("\t", *[F.coalesce(c, F.lit("")) for c in ("a", "b", "c")]).alias("value"))
        parts = (("index", malformed_lines(edges, EDGE_SCHEMA, sep="\t")),
                 ("results", malformed_results(self.spark.read.text(self.paths.results))))
        return union_all([d.select(F.lit(name).alias("source"), "n_rows", "n_malformed") for name, d in parts])

    def dictionary_rows(self) -> DataFrame:
        return read_split_lines(self.spark, self.paths.series_dictionary, SERIES_FIELDS, header=DICTIONARY_HEADER)

    @cached_property
    def dictionary(self) -> DataFrame:
        return self.dictionary_rows()

    @cached_property
    def level(self) -> DataFrame:
        return self._keep(level_by_unit(self.series, self.dictionary, self.region_names, self.names,
                                        self.params.level_year, MEASURE_LEVEL, alias="level",
                                        match=self.params.title_match, small=self.small_units))

    @cached_property
    def rate(self) -> DataFrame:
        return self._keep(level_by_unit(self.series, self.dictionary, self.region_names, self.names,
                                        self.params.level_year, MEASURE_RATE, alias="rate",
                                        match=self.params.title_match, small=self.small_units))

    def adjacency(self) -> DataFrame:
        if not self.paths.adjacency:
            raise ValueError("no adjacency file given")
        return read_sections(self.spark, self.paths.adjacency)
