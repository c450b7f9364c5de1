"""Binding of the driver's TPC-H-like tables to the analyses' inputs.

unit = supplier (``s_suppkey``), group = nation, link = supplier appears in
an order.  Every relation below is derived by Spark from the tables, so its
size grows with them.

===============  ======================================================
links            distinct (order, unit) from lineitem
raw index        connectivity index over links, diagonal included
edges            raw index without self pairs
centers          text coordinates from key arithmetic, ``NA`` when k%25=24
attitudes        per unit: share of its orders by priority 1..5
results          per unit: share of its lineitems with return flag R
series           per unit and year: monthly quantity (06), annual level
                 (06, M13 = yearly sum / 12), annual rate (03, M13 = share
                 of lineitems with status O)
dictionary       series id -> area type, region code, title
region names     region code -> group name
names            unit -> 'Unit k', group
result lines     comma text rows with quoted thousands and percent
adjacency        sectioned text: each unit with its key neighbours (k-1,
                 k+1) in the same nation
===============  ======================================================
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators.communities import merge_tree
from affinity.operators.edges import both_directions, drop_self_pairs, half_index, unit_sums
from affinity.operators.pairs import wide_units
from affinity.operators.sizing import is_small
from affinity.operators.units import (MEASURE_LEVEL, MEASURE_RATE, PERIOD_ANNUAL, SHARES, level_by_unit,
                                      parse_coordinates)
from affinity.plans.params import TEST_TABLES
from affinity.session import ensure_checkpoint_dir
from affinity.sources.delimited import malformed_lines, pad_id, parse_delimited, split_lines, union_all
from affinity.sources.results import malformed_results, parse_results_lines
from affinity.sources.sectioned import parse_sections
from affinity.sources.tables import read_table

# Fixed values of the binding (see FIXTURES.md §3); analysis parameters are
# in affinity.plans.params.TEST_TABLES.
NA_EVERY = 25
LAT_MULT, LAT_MOD = 7919, 3200
LON_MULT, LON_MOD = 104729, 7500
PRIORITIES = SHARES  # o_orderpriority 1..5
ID_WIDTH = 6                 # ids are padded to at least this many characters; longer ones stay whole
DICTIONARY_HEADER = "series_id"
BAD_EVERY = 7                # units whose line is spoilt in the texts with malformed rows
# Set ``spark.affinity.durableIndex=true`` on a cluster to checkpoint the
# connectivity index into spark.checkpoint.dir instead of caching it.
DURABLE_CONF = "spark.affinity.durableIndex"


_SHARED: dict[tuple[str, str], "Binding"] = {}


def _tag(root: str) -> str:
    return hashlib.sha1(os.path.abspath(root).encode()).hexdigest()[:12]


_TABLE_USERS: dict[str, int] = {}


def write_bucketed(spark: SparkSession, df: DataFrame, name: str, key: str | list[str],
                   buckets: int | None = None) -> tuple[DataFrame, str]:
    """``df`` as a parquet table bucketed and sorted by ``key`` (a column or several) under the
    shared checkpoint folder: (read back, table name).  A table of that name
    which this application has written and still uses is read, not written
    again; :func:`drop_bucketed` ends a use, and the last one drops it.

    The number of buckets is ``spark.affinity.indexBuckets`` if set, else
    ``spark.sql.shuffle.partitions``, so joins with shuffled sides line up
    bucket to bucket.  Rows are first hash-partitioned on ``key`` into
    exactly that many partitions (the same hash the bucketing uses), so each
    task writes one bucket file instead of one file per bucket it holds.
    """
    folder = ensure_checkpoint_dir(spark).rstrip("/")
    app = re.sub(r"[^0-9A-Za-z]", "_", spark.sparkContext.applicationId)
    table = f"affinity_{name}_{app}"
    if not _TABLE_USERS.get(table):
        n = buckets or int(spark.conf.get("spark.affinity.indexBuckets",
                                          spark.conf.get("spark.sql.shuffle.partitions")))
        keys = [key] if isinstance(key, str) else list(key)
        (df.repartition(n, *keys).write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys)
           .option("path", f"{folder}/affinity/{table}").saveAsTable(table))
    _TABLE_USERS[table] = _TABLE_USERS.get(table, 0) + 1
    return spark.table(table), table


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """End a use of a table; the last one drops it with its files."""
    _TABLE_USERS[table] = _TABLE_USERS.get(table, 1) - 1
    if _TABLE_USERS[table] > 0:
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/affinity/{table}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def binding_for(spark: SparkSession, root: str, keep: bool = True) -> "Binding":
    """One binding per (Spark application, root), so every query of a
    session reuses the same persisted edge and unit tables."""
    key = (spark.sparkContext.applicationId, os.path.abspath(root))
    b = _SHARED.get(key)
    durable = spark.conf.get(DURABLE_CONF, "false").lower() == "true"
    if b is None or b.spark is not spark or b.keep != keep or b.durable != durable:
        b = Binding(spark, root, keep=keep)
        _SHARED[key] = b
    return b


class Binding:
    """Lazily built, per (session, root) relations.  Nothing is computed
    until a query runs an action (but for the durable index, if it is asked
    for: a table is written when it is first needed).

    With ``keep`` the relations every analysis reuses (the edge table and
    the unit tables) are persisted with MEMORY_AND_DISK on first use: a
    lost executor's blocks are recomputed from lineage, and an edge table
    larger than memory spills instead of failing.
    """

    def __init__(self, spark: SparkSession, root: str, keep: bool = True, durable: bool | None = None):
        self.spark = spark
        self.root = root
        self.keep = keep
        self.params = TEST_TABLES
        if durable is None:
            durable = spark.conf.get(DURABLE_CONF, "false").lower() == "true"
        self.durable = durable
        self._index_table: str | None = None
        self._pair_table: str | None = None

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    def _keep(self, df: DataFrame) -> DataFrame:
        return df.persist(StorageLevel.MEMORY_AND_DISK) if self.keep else df

    def release(self) -> None:
        """Let go of every kept relation of this binding."""
        if "raw_index" in self.__dict__ and self._index_table is None:
            self.__dict__["raw_index"].unpersist()
        if "half_index" in self.__dict__:
            self.__dict__["half_index"].unpersist()
        if self._index_table is not None:
            drop_bucketed(self.spark, self._index_table)
            self._index_table = None
        if self._pair_table is not None:
            drop_bucketed(self.spark, self._pair_table)
            self._pair_table = None
        self.__dict__.pop("pair_buckets", None)
        self.__dict__.pop("half_index", None)
        self.__dict__.pop("raw_index", None)
        self.__dict__.pop("edges", None)
        self.__dict__.pop("merge_tree", None)
        for name in ("units_wide", "unit_sums", "monthly", "annual", "coords", "attitudes", "results", "names", "level", "rate"):
            if name in self.__dict__:
                self.__dict__[name].unpersist()
                del self.__dict__[name]
        for name in ("series", "result_lines", "index_lines", "noisy_index_lines", "noisy_result_lines"):
            self.__dict__.pop(name, None)

    @cached_property
    def small_units(self) -> bool:
        """Whether unit tables may be broadcast: known from the file size of
        the units' source, without a job."""
        return is_small(self.table("supplier"))

    # ----------------------------------------------------------- edges
    @cached_property
    def incidence(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_orderkey").alias("order"),
                                             F.col("l_suppkey").alias("unit"))

    @cached_property
    def half_index(self) -> DataFrame:
        """The index with u1 <= u2."""
        return half_index(self.incidence, "order", "unit", include_self=True, small_units=self.small_units)

    @cached_property
    def raw_index(self) -> DataFrame:
        idx = both_directions(self.half_index)
        if self.durable:
            # written once to the shared checkpoint folder as a table bucketed
            # by u1: lineage is cut (a lost executor never re-runs the pair
            # self-join), scans prune columns, and per-unit aggregations and
            # joins on u1 need no exchange of the index
            out, self._index_table = write_bucketed(self.spark, idx, f"index_{_tag(self.root)}", "u1")
            return out
        return self._keep(idx)

    @cached_property
    def edges(self) -> DataFrame:
        """From the whole index if a table or an earlier query holds it;
        else half of it is kept, in half the memory, and mirrored when read."""
        if self.durable or "raw_index" in self.__dict__:
            return drop_self_pairs(self.raw_index)
        return drop_self_pairs(both_directions(self._keep(self.half_index)))

    @cached_property
    def unit_sums(self) -> DataFrame:
        """Sum and number of each unit's scores, kept: one row a unit."""
        return self._keep(unit_sums(self.edges))

    @cached_property
    def pair_buckets(self) -> DataFrame:
        """Every edge once (u1 < u2; the index is symmetric) as a table bucketed
        by both ends, for joins of pair tables."""
        half = self.edges.where(F.col("u1") < F.col("u2"))
        out, self._pair_table = write_bucketed(self.spark, half, f"pairs_{_tag(self.root)}", ["u1", "u2"])
        return out

    @cached_property
    def merge_tree(self) -> DataFrame:
        """Mergers of the communities: one row each, in the shared folder."""
        return merge_tree(self.edges)

    # ----------------------------------------------------------- units
    @cached_property
    def centers(self) -> DataFrame:
        k = F.col("s_suppkey")
        na = (k % NA_EVERY) == NA_EVERY - 1
        lat = F.lit(20) + ((k * LAT_MULT) % LAT_MOD) / 100
        lon = F.lit(-132) + ((k * LON_MULT) % LON_MOD) / 100
        return self.table("supplier").select(
            k.alias("unit"),
            F.when(na, F.lit("NA")).otherwise(lat.cast("string")).alias("lat_s"),
            F.when(na, F.lit("NA")).otherwise(lon.cast("string")).alias("lon_s"))

    @cached_property
    def coords(self) -> DataFrame:
        return self._keep(parse_coordinates(self.centers))

    @cached_property
    def pair_coords(self) -> DataFrame:
        """Coordinates used for pair distances (one set of centres here)."""
        return self.coords

    @cached_property
    def units_wide(self) -> DataFrame:
        """One row per unit (per title match) with every attribute the pair
        features need; kept, since all pair queries attach it to the index."""
        return self._keep(wide_units(self.pair_coords, self.rate, self.results, self.attitudes))

    @cached_property
    def attitudes(self) -> DataFrame:
        # both sides are dealt by order first: one exchange serves to make
        # them distinct and to join them
        links = self.incidence.where(F.col("order").isNotNull() & F.col("unit").isNotNull()).repartition("order").distinct()
        od = self.table("orders").select(F.col("o_orderkey").alias("order"),
                                         F.substring("o_orderpriority", 1, 1).alias("prio"))
        # an order and its priority once, should orders repeat
        links = links.join(od.where(F.col("order").isNotNull()).repartition("order").distinct(), "order")
        shares = [F.avg((F.col("prio") == F.lit(str(i + 1))).cast("double")).alias(name)
                  for i, name in enumerate(PRIORITIES)]
        return self._keep(links.groupBy("unit").agg(*shares))

    @cached_property
    def results(self) -> DataFrame:
        """Share of a unit's lineitems with return flag R (null flags not
        counted).  One aggregation to units: its map side leaves one row a
        unit, where the monthly one leaves one a unit and month."""
        return self._keep(self.table("lineitem").groupBy(F.col("l_suppkey").alias("unit")).agg(
            F.try_divide(F.count_if(F.col("l_returnflag") == F.lit("R")), F.count("l_returnflag")).alias("result")))

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation").select("n_nationkey", "n_name")

    @cached_property
    def names(self) -> DataFrame:
        s = self.table("supplier").select(F.col("s_suppkey").alias("unit"), "s_nationkey")
        return self._keep(s.join(self.nation, s.s_nationkey == self.nation.n_nationkey)
                          .select("unit", F.concat(F.lit("Unit "), F.col("unit").cast("string")).alias("name"),
                                  F.col("n_name").alias("grp")))

    @cached_property
    def region_names(self) -> DataFrame:
        return self.nation.select(F.col("n_nationkey").cast("string").alias("srd"),
                                  F.col("n_name").alias("state"))

    # ---------------------------------------------------------- series
    @staticmethod
    def _sid(unit_col, measure: str):
        """Series id: the unit, padded but never cut, and the measure code."""
        return F.concat(pad_id(unit_col.cast("string"), ID_WIDTH), F.lit(measure))

    @cached_property
    def monthly(self) -> DataFrame:
        """Everything the series and result texts need from lineitem, in one scan and one
        aggregation to (unit, year, month): series values and the result
        text rows roll up from it.  It holds units x
        months rows, so it is kept."""
        li = self.table("lineitem")
        q = F.col("l_quantity")
        is_r = F.col("l_returnflag") == F.lit("R")
        return self._keep(li.groupBy(F.col("l_suppkey").alias("unit"),
                                     F.year("l_shipdate").alias("year"),
                                     F.month("l_shipdate").alias("month")).agg(
            F.sum(q).alias("qty"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("l_linestatus") == F.lit("O")).alias("n_open"),
            F.count_if(is_r).alias("n_r"),
            F.count("l_returnflag").alias("n_flag"),
            F.sum(F.when(is_r, q).otherwise(F.lit(0.0))).alias("qty_r"),
            F.sum(F.when(~is_r, q).otherwise(F.lit(0.0))).alias("qty_nr")))

    @cached_property
    def series(self) -> DataFrame:
        """Long-format series, assembled as a union of three parts (the
        union-of-partitions source in its general form)."""
        m = self.monthly
        monthly = m.select(self._sid(F.col("unit"), MEASURE_LEVEL).alias("sid"), "year",
                           F.concat(F.lit("M"), F.lpad(F.col("month").cast("string"), 2, "0")).alias("period"),
                           F.col("qty").alias("value"))
        yearly = m.groupBy("unit", "year").agg(F.sum("qty").alias("qty"), F.sum("n").alias("n"),
                                              F.sum("n_open").alias("n_open"))
        level = yearly.select(self._sid(F.col("unit"), MEASURE_LEVEL).alias("sid"), "year",
                              F.lit(PERIOD_ANNUAL).alias("period"), (F.col("qty") / 12).alias("value"))
        rate = yearly.select(self._sid(F.col("unit"), MEASURE_RATE).alias("sid"), "year",
                             F.lit(PERIOD_ANNUAL).alias("period"),
                             (F.col("n_open") / F.col("n")).alias("value"))
        return union_all([monthly, level, rate])

    @cached_property
    def annual(self) -> DataFrame:
        """Both measures of every unit in the analysis year, from one scan;
        the year is a date range on it, so other years are not read.  One row
        a unit, kept for level and rate."""
        li = self.table("lineitem")
        kind = li.schema["l_shipdate"].dataType
        year = self.params.level_year
        li = li.where((F.col("l_shipdate") >= F.lit(f"{year}-01-01").cast(kind))
                      & (F.col("l_shipdate") < F.lit(f"{year + 1}-01-01").cast(kind)))
        return self._keep(li.groupBy(F.col("l_suppkey").alias("unit")).agg(
            (F.sum("l_quantity") / 12).alias("level"),
            (F.count_if(F.col("l_linestatus") == F.lit("O")) / F.count(F.lit(1))).alias("rate")))

    def _annual(self, measure: str) -> DataFrame:
        """The annual values of one measure, in the form of ``series``."""
        return self.annual.select(
            self._sid(F.col("unit"), measure).alias("sid"), F.lit(self.params.level_year).alias("year"),
            F.lit(PERIOD_ANNUAL).alias("period"), F.col("level" if measure == MEASURE_LEVEL else "rate").alias("value"))

    @cached_property
    def dictionary(self) -> DataFrame:
        s = self.table("supplier").select(F.col("s_suppkey").alias("unit"), "s_nationkey")
        s = s.join(self.nation, s.s_nationkey == self.nation.n_nationkey)
        parts = []
        for measure, label in ((MEASURE_LEVEL, "Level"), (MEASURE_RATE, "Rate")):
            parts.append(s.select(
                self._sid(F.col("unit"), measure).alias("sid"),
                F.lit("F").alias("area_type"),
                F.col("s_nationkey").cast("string").alias("srd"),
                F.concat(F.lit(f"{label}: Unit "), F.col("unit").cast("string"), F.lit(", "),
                         F.col("n_name")).alias("title")))
        return union_all(parts)

    @cached_property
    def level(self) -> DataFrame:
        return self._keep(level_by_unit(self._annual(MEASURE_LEVEL), self.dictionary, self.region_names, self.names,
                                        self.params.level_year, MEASURE_LEVEL, alias="level",
                                        match=self.params.title_match, small=self.small_units))

    @cached_property
    def rate(self) -> DataFrame:
        return self._keep(level_by_unit(self._annual(MEASURE_RATE), self.dictionary, self.region_names, self.names,
                                        self.params.level_year, MEASURE_RATE, alias="rate",
                                        match=self.params.title_match, small=self.small_units))

    # ------------------------------------------------------------ text
    @cached_property
    def result_lines(self) -> DataFrame:
        """Comma text rows per unit (one line each) and header lines (one per
        nation), in the shapes a result file has: the difference without a
        separator and unquoted, or quoted with one or two separators.  To get
        them all, numbers of units k are divided by 100 (k % 3 = 0), taken as
        they are (1) or multiplied by 1000 (2)."""
        part = F.pmod(F.col("unit"), F.lit(3))

        def scaled(c):
            whole = F.sum(c).cast("bigint")
            return F.when(part == 0, F.floor(whole / 100)).when(part == 1, whole).otherwise(whole * 1000).cast("bigint")
        agg = self.monthly.groupBy("unit").agg(scaled("qty_r").alias("d"), scaled("qty_nr").alias("r"),
                                               scaled("qty").alias("t"))
        j = agg.join(self.names, "unit")
        gap = F.abs(F.col("d") - F.col("r"))
        # percent in whole hundredths, integer arithmetic; a zero total gives
        # empty fields (null after parsing) instead of a division error
        hund = F.when(F.col("t") != 0, F.expr("(abs(d - r) * 10000) div t"))
        pct = F.concat(F.floor(hund / 100).cast("string"), F.lit("."),
                       F.lpad((hund % 100).cast("string"), 2, "0"), F.lit("%"))

        def text(c):
            return F.coalesce(c.cast("string"), F.lit(""))
        line = F.concat_ws(",",
                           text(F.col("unit")), text(F.col("d")), text(F.col("r")), text(F.col("t")),
                           text(F.try_divide(F.col("d"), F.col("t"))),
                           text(F.try_divide(F.col("r"), F.col("t"))),
                           F.when(gap < 1000, text(gap)).otherwise(
                               F.concat(F.lit('"'), F.format_number(gap, 0), F.lit('"'))),
                           text(pct), F.col("grp"), F.col("name"), text(F.col("unit")))
        header = self.nation.select(F.concat(F.lit(",votes_dem,votes_gop,total_votes,"), F.col("n_name")).alias("value"))
        return j.select(line.alias("value")).unionByName(header)

    @cached_property
    def noisy_result_lines(self) -> DataFrame:
        """The result lines, with text in place of a number in those of every
        seventh unit."""
        v = F.col("value")
        unit = F.get(F.split(v, ","), 0).try_cast("bigint")
        spoilt = F.regexp_replace(v, r"^(\d+),[^,]*,", "$1,n/a,")
        return self.result_lines.select(F.when(F.pmod(unit, F.lit(BAD_EVERY)) == 0, spoilt).otherwise(v).alias("value"))

    @cached_property
    def noisy_index_lines(self) -> DataFrame:
        """The index lines, without a number as score where both ends are the
        same unit, for every seventh unit."""
        r = self.raw_index
        bad = (F.col("u1") == F.col("u2")) & (F.pmod(F.col("u1"), F.lit(BAD_EVERY)) == 0)
        return r.select(F.concat_ws("\t", F.col("u1").cast("string"), F.col("u2").cast("string"),
                                    F.when(bad, F.lit("n/a")).otherwise(F.col("w").cast("string"))).alias("value"))

    @cached_property
    def index_lines(self) -> DataFrame:
        """The index, self pairs included, as tab-separated text lines (the
        form a published index file has)."""
        r = self.raw_index
        return r.select(F.concat_ws("\t", F.col("u1").cast("string"), F.col("u2").cast("string"),
                                    F.col("w").cast("string")).alias("value"))

    @cached_property
    def dictionary_lines(self) -> DataFrame:
        """The series dictionary as padded tab-separated lines with seven
        fields: id, area type, area code, measure, seasonal flag, region
        code, title; and its header row."""
        d = self.dictionary
        pad = F.lit(" ")
        unit, measure = F.expr("left(sid, length(sid) - 2)"), F.expr("right(sid, 2)")
        lines = d.select(F.concat_ws(
            "\t", F.concat(F.col("sid"), pad), F.col("area_type"),
            F.concat(F.lit("CN"), unit), measure, F.lit("U"),
            F.concat(pad, F.col("srd")), F.concat(F.col("title"), pad)).alias("value"))
        header = self.nation.where("n_nationkey = 0").select(F.lit(
            f"{DICTIONARY_HEADER}\tarea_type_code\tarea_code\tmeasure_code\tseasonal\tsrd_code\tseries_title").alias("value"))
        return lines.unionByName(header)

    # ------------------------------------------- text-source parses
    def text_edges(self) -> DataFrame:
        """The index text lines read with a fixed schema, self pairs removed
        (the load path of a published index file)."""
        return drop_self_pairs(parse_delimited(self.index_lines, "u1 bigint, u2 bigint, w bigint", sep="\t"))

    def parsed_results(self, exclude: tuple = ()) -> DataFrame:
        return parse_results_lines(self.result_lines, exclude_states=exclude)

    def adjacency(self) -> DataFrame:
        return parse_sections(self.adjacency_sections)

    def dictionary_rows(self) -> DataFrame:
        return split_lines(self.dictionary_lines, {"sid": 0, "area_type": 1, "area_code": 2,
                                                   "measure_code": 3, "srd": 5, "title": 6}, header=DICTIONARY_HEADER)

    def malformed(self) -> DataFrame:
        """Lines of the two kinds of text that do not parse: source, n_rows,
        n_malformed."""
        parts = (("index", malformed_lines(self.noisy_index_lines, "u1 bigint, u2 bigint, w bigint", sep="\t")),
                 ("results", malformed_results(self.noisy_result_lines)))
        return union_all([d.select(F.lit(name).alias("source"), "n_rows", "n_malformed") for name, d in parts])

    @cached_property
    def adjacency_sections(self) -> DataFrame:
        """One text section per unit: the unit and its neighbours (itself and
        the suppliers with key k-1 / k+1 in the same nation), sorted by id."""
        s = self.table("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("nk"))
        prev = s.select((F.col("k") + 1).alias("k"), "nk", F.col("k").alias("prev"))
        nxt = s.select((F.col("k") - 1).alias("k"), "nk", F.col("k").alias("next"))
        j = s.join(prev, ["k", "nk"], "left").join(nxt, ["k", "nk"], "left")

        def entry(c):
            return F.when(c.isNotNull(), F.struct(c.alias("id"),
                                                  F.concat(F.lit("Unit "), c.cast("string")).alias("nm")))
        nb = F.filter(F.array(entry(F.col("prev")), entry(F.col("k")), entry(F.col("next"))),
                      lambda x: x.isNotNull())

        def line(x):
            return F.concat(F.lit('"'), x["nm"], F.lit('"\t'), x["id"].cast("string"))
        first = F.concat(F.lit('"Unit '), F.col("k").cast("string"), F.lit('"\t'),
                         F.col("k").cast("string"), F.lit("\t"), line(F.get(F.col("nb"), 0)))
        rest = F.transform(F.slice(F.col("nb"), 2, 3), lambda x: F.concat(F.lit("\t\t"), line(x)))
        return (j.select("k", nb.alias("nb"))
                .select(F.array_join(F.concat(F.array(first), rest), "\n").alias("value")))
