"""Join helpers: scalars without keyless joins.

Which side of a join is broadcast is left to Catalyst and AQE, which go by bytes; AQE also
splits the partitions of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def one_row(agg: DataFrame):
    """The single row of a global aggregate, on the driver (a bounded result).

    Scalars such as a total, a mean or a record count are brought back this
    way and used as literals, so no keyless join (cross product) appears in
    any plan.
    """
    rows = agg.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected a one-row aggregate, got {len(rows)} rows")
    return rows[0]
