"""Median peak ground acceleration of a published ground-motion model, as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values of the published model (PGA, by distance metric) ---
BY_DISTANCE = {"rhypo": {"a1": 3.26685, "a3": -0.04846, "a4": -1.47905}, "repi": {"a1": 2.52977, "a3": -0.05496, "a4": -1.31001}}
A2, A5, A6, A7, A8, A9 = 0.0029, 0.2529, 7.5, -0.5096, -0.1091, 0.0937
B1, B2, C, N = -0.41997, -0.28846, 2.5, 3.2
M_HINGE, V_REF, V_CON = 6.75, 750.0, 1000.0


def median_pga(magnitude: Column, distance_km: Column, vs30: Column, metric: str = "rhypo", normal: Column | None = None, reverse: Column | None = None) -> Column:
    """PGA in g; strike-slip unless ``normal`` or ``reverse`` (boolean columns) hold."""
    k = BY_DISTANCE[metric]
    m = magnitude - M_HINGE
    style = F.lit(0.0)
    for flag, term in ((normal, A8), (reverse, A9)):
        if flag is not None:
            style = style + F.when(flag, F.lit(term)).otherwise(F.lit(0.0))
    reach = F.ln(F.sqrt(distance_km * distance_km + A6 * A6))
    rock = k["a1"] + F.when(magnitude <= M_HINGE, m * A2).otherwise(m * A7) + F.pow(8.5 - magnitude, F.lit(2.0)) * k["a3"] + (m * A5 + k["a4"]) * reach + style
    v = F.least(vs30, F.lit(V_CON)) / V_REF
    vn = F.pow(v, F.lit(N))
    soft = F.ln((F.exp(rock) + vn * C) / ((F.exp(rock) + C) * vn)) * B2
    return F.exp(rock + F.ln(v) * B1 + F.when(vs30 < V_REF, soft).otherwise(F.lit(0.0)))


def log_residual(observed: Column, predicted: Column) -> Column:
    return F.log10(observed) - F.log10(predicted)
