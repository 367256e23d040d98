"""The user-defined-function surface.

D2 to D5 of the reference are replaced by native expressions
(``functions.logs.clf_time``, ``sources.readers.positional_fields``,
``operators.features.sparse_vector`` and ``pyspark.ml.functions.vector_to_array``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def less_than(bound: float):
    """An Arrow-batched boolean predicate (value < bound)."""

    @F.pandas_udf(T.BooleanType())
    def _lt(s: pd.Series) -> pd.Series:
        return s < bound

    return _lt
