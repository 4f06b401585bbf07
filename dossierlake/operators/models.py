"""Linear, probit and fixed-effects models of panels, by sums computed in the cluster and solved on the driver."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

MAX_TERMS = 200


def _moments(df: DataFrame, x: list[Column], y: Column, w: Column) -> tuple[np.ndarray, np.ndarray]:
    """X'WX and X'Wy by one aggregate."""
    n = len(x)
    cells = [F.sum(w * x[i] * x[j]) for i in range(n) for j in range(i, n)] + [F.sum(w * xi * y) for xi in x]
    row = [0.0 if v is None else float(v) for v in df.agg(*(c.alias(f"c{k}") for k, c in enumerate(cells))).first()]
    a = np.zeros((n, n))
    a[np.triu_indices(n)] = row[: n * (n + 1) // 2]
    return a + np.triu(a, 1).T, np.array(row[n * (n + 1) // 2 :])


def _terms(df: DataFrame, columns: list[str], dummies: str | None) -> tuple[list[str], list[Column]]:
    names, terms = ["const", *columns], [F.lit(1.0), *(F.col(c).cast("double") for c in columns)]
    if dummies:
        levels = [r[0] for r in df.select(dummies).distinct().orderBy(dummies).limit(MAX_TERMS + 1).collect()]
        if len(levels) > MAX_TERMS:
            raise ValueError(f"more than {MAX_TERMS} levels of {dummies}")
        names += [f"{dummies}={v}" for v in levels[1:]]
        terms += [(F.col(dummies) == v).cast("double") for v in levels[1:]]
    return names, terms


def least_squares(df: DataFrame, y: str, columns: list[str], dummies: str | None = None) -> dict[str, float]:
    """Coefficients of an ordinary regression; rows with a missing value are left out."""
    known = df.select(y, *columns, *([dummies] if dummies else [])).dropna()
    names, terms = _terms(known, columns, dummies)
    a, b = _moments(known, terms, F.col(y).cast("double"), F.lit(1.0))
    return dict(zip(names, np.linalg.lstsq(a, b, rcond=None)[0].tolist()))


def fixed_effects(df: DataFrame, y: str, columns: list[str], unit: str) -> dict[str, float]:
    """Coefficients within units: everything is taken as the distance from its unit's mean. Means are aggregated first, so hot units do not gather in one task."""
    known = df.select(unit, y, *columns).dropna()
    means = known.groupBy(unit).agg(*(F.avg(c).alias("_m_" + c) for c in (y, *columns)))
    near = known.join(means, unit).select(*((F.col(c) - F.col("_m_" + c)).alias(c) for c in (y, *columns)))
    a, b = _moments(near, [F.col(c).cast("double") for c in columns], F.col(y), F.lit(1.0))
    return dict(zip(columns, np.linalg.lstsq(a, b, rcond=None)[0].tolist()))


def probit(df: DataFrame, y: str, columns: list[str], dummies: str | None = None, rounds: int = 25, tolerance: float = 1e-8) -> dict[str, float]:
    """Coefficients of a probit model by Fisher scoring: one aggregate for each round."""
    known = df.select(y, *columns, *([dummies] if dummies else [])).dropna().cache()
    names, terms = _terms(known, columns, dummies)
    beta = np.zeros(len(names))
    for _ in range(rounds):
        eta = sum((t * float(b) for t, b in zip(terms, beta)), F.lit(0.0))
        # the normal distribution function by the error function's rational approximation (Abramowitz and Stegun 7.1.26)
        z = F.abs(eta) / math.sqrt(2)
        t = 1 / (1 + 0.3275911 * z)
        tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-z * z)
        p = F.least(F.greatest(F.when(eta >= 0, 1 - tail / 2).otherwise(tail / 2), F.lit(1e-10)), F.lit(1 - 1e-10))
        d = F.exp(-eta * eta / 2) / math.sqrt(2 * math.pi)
        work = known.select("*", eta.alias("_eta"), p.alias("_p"), F.greatest(d, F.lit(1e-12)).alias("_d"))
        weight = F.col("_d") * F.col("_d") / (F.col("_p") * (1 - F.col("_p")))
        a, b = _moments(work, terms, F.col("_eta") + (F.col(y) - F.col("_p")) / F.col("_d"), weight)
        new = np.linalg.lstsq(a, b, rcond=None)[0]
        done, beta = np.abs(new - beta).max() < tolerance, new
        if done:
            break
    known.unpersist()
    return dict(zip(names, beta.tolist()))
