"""Boosted trees with a Poisson objective (log link).

State: margin F (log rate), starting at log(mean(y)).  With mu = exp(F), a
round grows a tree on gradient mu - y and hessian mu, whose leaves step
-G / (H + lambda), cut to +-max_delta_step (0.7, the usual Poisson default),
times the learning rate.  ``min_child_weight`` bounds the sum of hessians of
both children.  The rounds are those of ``ensembles.boost``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..features import LABEL
from .ensembles import TreeEnsemble
from .estimators import ModelSpec
from .trainer import fit

MU_FLOOR = 1e-6


class PoissonBoostRegressor:
    """Poisson boosting by keyword parameters (those of ``xgboost_poisson``)."""

    def __init__(self, seed: int = 42, key: str | None = None, **params):
        self.key, self.spec = key, ModelSpec("xgboost_poisson", params, seed)

    def fit(self, train: DataFrame) -> TreeEnsemble:
        return fit(self.spec, train).model


def poisson_deviance(df: DataFrame, label: str = LABEL, prediction: str = "prediction") -> float:
    """Mean Poisson deviance 2 * (y log(y/mu) - (y - mu))."""
    y, mu = F.col(label), F.greatest(F.col(prediction), F.lit(MU_FLOOR))
    term = F.when(y > 0, y * F.log(y / mu)).otherwise(F.lit(0.0)) - (y - mu)
    return float(df.agg(F.avg(2 * term)).first()[0])
