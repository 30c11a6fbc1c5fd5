"""User functions over column batches and rows (the map/filter surface of the scripts).

``map_batches`` runs a pandas function over Arrow batches of each partition
(``mapInPandas``); row counts may change. ``filter_rows`` takes a Column
(preferred: stays in the JVM) or a vectorized pandas predicate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_batches(df: DataFrame, fn: Callable[..., pd.DataFrame], schema: T.StructType | str,
                **kwargs: Any) -> DataFrame:
    """Apply ``fn(batch: pd.DataFrame, **kwargs) -> pd.DataFrame`` to every Arrow batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b, **kwargs)

    return df.mapInPandas(run, schema)


def filter_rows(df: DataFrame, predicate: Column | Callable[[pd.DataFrame], pd.Series],
                columns: list[str] | None = None) -> DataFrame:
    """Keep rows where ``predicate`` holds.

    A Column predicate is pushed into the plan as is; a callable gets a pandas
    DataFrame of ``columns`` per batch and returns a boolean Series.
    """
    if isinstance(predicate, Column):
        return df.where(predicate)
    cols = columns or df.columns

    @F.pandas_udf(T.BooleanType())
    def keep(*series: pd.Series) -> pd.Series:
        frame = pd.concat(series, axis=1, keys=cols)
        return predicate(frame).astype(bool)

    return df.where(keep(*[F.col(c) for c in cols]))
