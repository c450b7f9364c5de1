"""Sectioned adjacency text.

Each section starts with a line beginning with a quote::

    "Name A"<TAB>idA<TAB>"Name B"<TAB>idB
    <TAB><TAB>"Name C"<TAB>idC

The first line names the unit (field 0, quoted) and its id (field 1); every
line's last field is a neighbour id.  A unit listed as its own neighbour is
dropped.  Spark splits the file into sections with a custom record
separator, so sections are parsed in parallel, one record each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.numeric import strip_text

SECTION_SEP = '\n"'


def read_sections(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", SECTION_SEP).text(path)
    return parse_sections(raw)


def parse_sections(sections: DataFrame, col: str = "value") -> DataFrame:
    """One section per row -> exploded ``(unit, unit_name, neighbor)`` rows."""
    body = F.regexp_replace(F.col(col), r'^"', "")  # only the first record keeps its quote
    lines = F.filter(F.split(body, "\r?\n"), lambda l: F.length(strip_text(l)) > 0)
    head = F.split(F.get(lines, 0), "\t")
    name = F.regexp_replace(strip_text(F.get(head, 0)), r'"$', "")
    own = strip_text(F.get(head, 1))
    nbrs = F.transform(lines, lambda l: strip_text(F.element_at(F.split(l, "\t"), -1)))
    return (sections
            .select(own.alias("unit"), name.alias("unit_name"), F.explode(nbrs).alias("neighbor"))
            .where(F.col("neighbor") != F.col("unit")))
