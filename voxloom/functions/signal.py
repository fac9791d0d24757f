"""Features of sampled sound, on arrays of samples as Column builders."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def zero_crossing_rate(samples: Column) -> Column:
    """Share of samples whose sign differs from the one before; null for null or empty arrays."""
    n = F.size(samples)
    changes = F.filter(F.sequence(F.lit(2), n), lambda i: (F.element_at(samples, i) < 0) != (F.element_at(samples, i - 1) < 0))
    return F.when(n > 1, F.size(changes) / n).when(n == 1, F.lit(0.0))


def spectral_centroid(samples: Column, rate: int) -> Column:
    """Mean frequency (Hz) of a frame's spectrum, weighted by magnitude; 0 for silence, null for null or empty frames."""
    return _centroid(samples) * F.lit(float(rate))


@F.pandas_udf(DoubleType())
def _centroid(samples: pd.Series) -> pd.Series:
    def one(x) -> float | None:
        if x is None or not len(x):
            return None
        m = np.abs(np.fft.rfft(np.asarray(x, dtype=float)))
        return float((m * np.fft.rfftfreq(len(x))).sum() / m.sum()) if m.sum() > 0 else 0.0

    return samples.map(one)
