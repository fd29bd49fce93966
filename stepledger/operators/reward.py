"""Rewards from subscores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepledger.domain import AGGREGATIONS, DEFAULT, SUBSCORES, Domain
from stepledger.operators.verify import verify_steps


def step_reward(result: Column, weights: dict[str, float]) -> Column:
    """Weighted sum of a result's subscores; weights of unknown names count nothing and none are rescaled."""
    parts = [result[name] * F.lit(float(w)) for name, w in weights.items() if name in SUBSCORES]
    return reduce(lambda a, b: a + b, parts, F.lit(0.0))


def record_reward(results: Column, weights: dict[str, float], aggregation: str = "mean") -> Column:
    """Mean, least or product of the rewards of a record's steps; null for a record without steps."""
    if aggregation not in AGGREGATIONS:
        raise ValueError(f"unknown aggregation {aggregation!r}")
    rewards = F.transform(results, lambda r: step_reward(r, weights))
    n = F.size(results)
    if aggregation == "min":
        out = F.array_min(rewards)
    elif aggregation == "mean":
        out = F.aggregate(rewards, F.lit(0.0), lambda a, x: a + x) / F.nullif(n, F.lit(0))
    else:
        out = F.aggregate(rewards, F.lit(1.0), lambda a, x: a * x)
    return F.when(n > 0, out)


def rollout_reward(steps: DataFrame, preset: str = "shaped", domain: Domain = DEFAULT, name: str = "reward") -> DataFrame:
    """Steps with the reward of what was called, whatever trigger the record expected."""
    judged = verify_steps(steps, domain, infer=True, trigger="", result=f"{name}_result")
    return judged.withColumn(name, step_reward(F.col(f"{name}_result"), domain.preset(preset)))
