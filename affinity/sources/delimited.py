"""Delimited text: fixed-schema scans, tab-split line scans, unions of
same-schema partition files, and counts of lines that do not parse."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from affinity.functions.numeric import strip_text


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, sep: str = "\t",
                   header: bool = True, mode: str = "PERMISSIVE") -> DataFrame:
    """Fixed schema, header skipped, columns bound by position.

    ``mode='PERMISSIVE'`` turns malformed numerics into nulls; pass
    ``'FAILFAST'`` to make them an error instead.
    """
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("mode", mode).csv(path))


def parse_delimited(lines: DataFrame, schema: str, sep: str = "\t", col: str = "value") -> DataFrame:
    """The fixed-schema parse of :func:`read_delimited` applied to a column
    of text lines (e.g. produced by another job): fields bind by position,
    malformed numerics become null."""
    rec = F.from_csv(F.col(col), schema, {"sep": sep, "mode": "PERMISSIVE"}).alias("r")
    return lines.select(rec).select("r.*")


def malformed_lines(lines: DataFrame, schema: str, sep: str = "\t", col: str = "value") -> DataFrame:
    """One row: ``n_rows`` non-empty lines, and ``n_malformed`` of them in
    which a field is there but does not parse as its type, which the parse
    turns into a silent null."""
    types = StructType.fromDDL(schema)
    fields = F.split(F.col(col), sep)
    bad = F.lit(False)
    for i, f in enumerate(types.fields):
        raw = strip_text(F.get(fields, i))
        bad = bad | F.coalesce((F.length(raw) > 0) & raw.try_cast(f.dataType).isNull(), F.lit(False))
    return (lines.where(F.length(strip_text(col)) > 0)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_malformed")))


def read_split_lines(spark: SparkSession, path: str, fields: Mapping[str, int], sep: str = "\t",
                     header: str | None = None) -> DataFrame:
    """Line scan, split on ``sep``, trim every field, project fields by
    position (0-based).  Missing positions give null.  ``header`` is the first
    field of the file's header row, which is dropped."""
    return split_lines(spark.read.text(path), fields, sep, header)


def split_lines(lines: DataFrame, fields: Mapping[str, int], sep: str = "\t",
                header: str | None = None, col: str = "value") -> DataFrame:
    """:func:`read_split_lines` on a column of text lines."""
    parts = F.split(F.col(col), sep)
    if header is not None:
        lines = lines.where(F.coalesce(strip_text(F.get(parts, 0)) != F.lit(header), F.lit(True)))
    return lines.select(*[strip_text(F.get(parts, i)).alias(name) for name, i in fields.items()])


def union_all(frames: Iterable[DataFrame], by_name: bool = True) -> DataFrame:
    """Union keeping duplicates (UNION ALL).  ``by_name`` aligns columns by
    name rather than position."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one DataFrame")
    if by_name:
        return reduce(lambda a, b: a.unionByName(b), frames)
    return reduce(lambda a, b: a.union(b), frames)


def read_partitioned(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str,
                     sep: str = "\t", header: bool = True, trim: Sequence[str] = ()) -> DataFrame:
    """Many same-schema files as one relation: one scan over a glob or a
    path list instead of a union of per-file reads."""
    df = read_delimited(spark, paths if isinstance(paths, str) else list(paths), schema, sep, header)
    return df.withColumns({c: strip_text(c) for c in trim}) if trim else df


def pad_id(c: Column, width: int) -> Column:
    """Text id padded with zeros on the left to at least ``width``
    characters; longer ids stay whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def normalize_id(col: str | Column, width: int = 5) -> Column:
    """Canonical text id: stripped and padded, so ``1001``, ``01001`` and
    `` 1001`` name the same unit.  Finer ids such as ``01001020100`` keep all
    their characters."""
    c = F.col(col) if isinstance(col, str) else col
    return pad_id(strip_text(c.cast("string")), width)
