"""Threshold ladders of the risk score (F13, X9) as chained ``when``.

Ladders are (threshold, score) steps checked top-down with ``>=`` (or
``>`` for the size ladder); the first match wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# percent_decline ladder (threshold, score, direction text).
SLOPE_STEPS = [
    (0.25, -12, "increase"), (0.20, -12, "increase"), (0.15, -10, "increase"),
    (0.10, -8, "increase"), (0.05, -4, "increase"), (0.0, -2, "increase"),
    (-0.05, 2, "decrease"), (-0.10, 4, "decrease"), (-0.15, 8, "decrease"),
    (-0.20, 10, "decrease"), (-0.25, 12, "decrease"),
]
SLOPE_ELSE = (12, "decrease")


# Magnitude ladder (threshold, score).
MAGNITUDE_STEPS = [
    (0.5, -10.0), (0.45, -9.0), (0.4, -8.0), (0.35, -7.0), (0.3, -6.0),
    (0.25, -5.0), (0.2, -4.0), (0.15, -3.0), (0.1, -2.0), (0.05, -1.0),
    (0.0, 0.0), (-0.05, 0.5), (-0.1, 1.0), (-0.15, 1.5), (-0.2, 2.0),
    (-0.25, 2.5), (-0.3, 3.0), (-0.35, 3.5), (-0.4, 4.0), (-0.45, 4.5),
    (-0.5, 5.0),
]
MAGNITUDE_ELSE = 5.0

# Missed-period ladder (threshold, score, text).
PERIOD_STEPS = [
    (1.5, -3, "Increase"), (1.0, -2, "Increase"), (0.5, 1, "Increase"),
    (0.0, 0, "No change"), (-0.5, 1, "Missed"), (-1.5, 2, "Missed"),
]
PERIOD_ELSE = (3, "Missed")

# Size ladder on max_cch (strictly greater).
SIZE_STEPS = [(100, 8), (50, 6), (20, 5), (10, 4)]
SIZE_ELSE = 3

# Weights of the score and its normaliser 1*1.2 + 1.6*0.5 + 0.15.
MAGNITUDE_WEIGHT = 1.6
SCORE_NORMALISER = 1 * 1.2 + 1.6 * 0.5 + 0.15


def ladder(x: Column, steps: Sequence[tuple], default, strict: bool = False, pick: int = 1) -> Column:
    out = None
    for step in steps:
        cond = x > step[0] if strict else x >= step[0]
        val = F.lit(step[pick])
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(F.lit(default))
