"""The interface every registered query reads from.

Both :class:`affinity.plans.binding.Binding` (test tables) and
:class:`affinity.plans.files.FileInputs` (original file formats) provide it;
any other source can too, and then runs every query in the catalog.

Relations (unit ids may be any comparable type):

===============  ==========================================================
raw_index        (u1, u2, w) scored pairs, self pairs included
edges            (u1, u2, w) without self pairs
coords           (unit, lat, lon) map coordinates (null when unknown)
pair_coords      (unit, lat, lon) coordinates for pair distances
attitudes        (unit, never, rarely, sometimes, freq, always) shares
results          (unit, result) result share
names            (unit, name, grp) name and group of each unit
region_names     (srd, state) region code -> group name
series           (sid, year, period, value) long-format series
dictionary       (sid, area_type, srd, title, ...) series dictionary
level, rate      (unit, level) / (unit, rate) through the title match
===============  ==========================================================

plus the parsed text sources (``text_edges``, ``parsed_results``,
``adjacency``, ``dictionary_rows``) and ``params``
(:class:`affinity.plans.params.Params`).
"""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession

from affinity.plans.params import Params


@runtime_checkable
class Inputs(Protocol):
    spark: SparkSession
    params: Params
    small_units: bool
    raw_index: DataFrame
    edges: DataFrame
    coords: DataFrame
    pair_coords: DataFrame
    attitudes: DataFrame
    results: DataFrame
    names: DataFrame
    region_names: DataFrame
    series: DataFrame
    dictionary: DataFrame
    level: DataFrame
    rate: DataFrame

    def text_edges(self) -> DataFrame: ...

    def parsed_results(self, exclude: tuple = ()) -> DataFrame: ...

    def adjacency(self) -> DataFrame: ...

    def dictionary_rows(self) -> DataFrame: ...

    def malformed(self) -> DataFrame: ...

    def release(self) -> None: ...
