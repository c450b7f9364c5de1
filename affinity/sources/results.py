"""Result rows in comma-separated text with quoted thousands separators and
percent signs, e.g.::

    0,93003,130413,246588,0.377,0.529,"37,410",15.17%,AK,Alaska,2013

Columns: line_num, d_votes, r_votes, total_votes, per_dem, per_rep, diff,
per_pt_diff, state, county, fips.  Lines starting with a comma (the
header) are dropped.  The CSV parser understands the quotes, so a number
like ``"1,234,567"`` is one field; removing the separators and casting
gives the value (also for negative numbers).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.numeric import strip_text

RAW_SCHEMA = ("line_num string, d_votes string, r_votes string, total_votes string, "
              "per_dem string, per_rep string, diff string, per_pt_diff string, "
              "state string, county string, fips string")


def read_results(spark: SparkSession, path: str, exclude_states: Sequence[str] = ()) -> DataFrame:
    return parse_results_lines(spark.read.text(path), exclude_states=exclude_states)


def _records(lines: DataFrame, col: str) -> DataFrame:
    rec = F.from_csv(F.col(col), RAW_SCHEMA, {"quote": '"'}).alias("r")
    return lines.where(~F.startswith(F.col(col), F.lit(","))).select(rec).select("r.*")


def _numbers() -> dict[str, Column]:
    """The numeric fields, parsed from their text; null where it fails."""
    def whole(c):  # "93003" or "93003.0" -> 93003
        return strip_text(c).try_cast("double").cast("bigint")
    return {
        "line_num": strip_text("line_num").try_cast("bigint"),
        "d_votes": whole("d_votes"),
        "r_votes": whole("r_votes"),
        "total_votes": whole("total_votes"),
        "per_dem": strip_text("per_dem").try_cast("double"),
        "per_rep": strip_text("per_rep").try_cast("double"),
        "diff": F.regexp_replace(strip_text("diff"), ",", "").try_cast("bigint"),
        "per_pt_diff": F.rtrim(strip_text("per_pt_diff"), F.lit("%")).try_cast("double"),
    }


def malformed_results(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row: ``n_rows`` result lines (headers left out), and
    ``n_malformed`` of them with a number that is there but does not parse."""
    bad = F.lit(False)
    for name, value in _numbers().items():
        bad = bad | F.coalesce((F.length(strip_text(name)) > 0) & value.isNull(), F.lit(False))
    return _records(lines, col).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_malformed"))


def parse_results_lines(lines: DataFrame, col: str = "value",
                        exclude_states: Sequence[str] = ()) -> DataFrame:
    parsed = _records(lines, col)

    out = parsed.select(
        *[value.alias(name) for name, value in _numbers().items()],
        *[strip_text(c).alias(c) for c in ("state", "county", "fips")],
    )
    for s in exclude_states:
        out = out.where(F.col("state") != F.lit(s))
    return out
