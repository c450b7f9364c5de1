"""Analysis parameters carried by an inputs object (the test-table binding
or the original file inputs), so one query body serves both."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    level_year: int                      # year of the annual (M13) level / rate
    attitude_threshold: float = 0.5      # label 0 when never+rarely+sometimes > this
    conn_threshold: float | None = 15000.0  # label 0 when mean score < this; None = mean pair score
    fanout_unit: object = None           # unit whose partners the fan-out map shows
    excluded_groups: tuple = ()          # groups dropped from the result rows
    hist_weight: tuple = (1000.0, 1000000.0, 1000.0)   # (first edge, last edge, step), all scores
    hist_max: tuple = (1.0, 70000000.0, 1000000.0)     # same, per-unit maxima
    hist_edges: tuple = (1.0, 10000.0, 200000.0, 5000000.0, 1000000000.0)  # explicit edges, all scores
    prefix_chars: int = 2                # leading characters of an id that name its group
    n_communities: int | None = None     # None = as many as there are known groups
    title_match: str = "all"             # 'all' matches (as the original) or 'longest' per title


# Fixed values of the original analysis: year 2010, mask threshold 0.5,
# connectivity threshold 15000, Alaska and Hawaii excluded; histogram edges
# 1000..1,000,000 step 1000 (all scores) and 1..70,000,000 step 1,000,000
# (maxima).
REFERENCE = Params(level_year=2010, attitude_threshold=0.5, conn_threshold=15000.0,
                   excluded_groups=("AK", "HI"))

# The test-table binding (FIXTURES.md §3): threshold 0.6 on the first three
# shares, connectivity threshold = mean pair score, year 1998.
TEST_TABLES = Params(level_year=1998, attitude_threshold=0.6, conn_threshold=None, fanout_unit=1,
                     excluded_groups=("NATION_23", "NATION_24"),
                     hist_weight=(1000.0, 1000000.0, 1000.0), hist_max=(0.0, 1004000.0, 10000.0),
                     hist_edges=(0.0, 500.0, 20000.0, 300000.0, 1000000000.0), prefix_chars=1)
