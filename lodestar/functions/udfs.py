"""The one user-defined function kept (survey X1, X3).

Built-in expressions cover every operator; this Arrow-batched pandas UDF
exists to show the supported slow path: a vectorised banding rule with a
declared return type, callable from the DataFrame API and — after
``register`` — from SQL. NULL in, NULL out (the reference's row UDF raised).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf

# fixed values: band edges and labels of the reference's development rule
BAND_EDGES = (450.0, 6000.0)
BAND_LABELS = ("Underdeveloped", "Developing", "Developed")


@pandas_udf("string")
def band_udf(x: pd.Series) -> pd.Series:
    lo, hi = BAND_EDGES
    out = np.where(x < lo, BAND_LABELS[0], np.where(x < hi, BAND_LABELS[1], BAND_LABELS[2]))
    return pd.Series(out, dtype="object").where(x.notna(), None)


def register(spark: SparkSession, name: str = "lodestar_band") -> str:
    """Make the UDF callable from SQL."""
    spark.udf.register(name, band_udf)
    return name
