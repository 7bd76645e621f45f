"""Scorers: families that learn from a bounded context, and which of them a run takes.

A context is what a policy bounds: some thousand rows. Books of any size are scored in place."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import FEATURES, LABEL
from ..session import cut

#: Fits on a context and returns a function that adds a column p to rows with the features.
Scorer = Callable[[DataFrame], Callable[[DataFrame], DataFrame]]

#: Rows that an in-context scorer carries to every task at most.
MOST_CONTEXT = 10_000


def moments(rows: DataFrame, features: Sequence[str]) -> list[tuple[float, float]]:
    """Mean and standard deviation (of the population) of each feature, from one aggregate; 1 for a feature that does not vary."""
    found = rows.agg(*[f(F.col(c).cast("double")) for c in features for f in (F.avg, F.stddev_pop)]).first()
    return [(found[2 * i] or 0.0, found[2 * i + 1] or 1.0) for i in range(len(features))]


def standardised(features: Sequence[str], of: Sequence[tuple[float, float]]) -> Column:
    """The features less their means over their deviations, an array; a missing value counts as the mean."""
    return F.array(*[F.coalesce((F.col(c).cast("double") - F.lit(m)) / F.lit(s), F.lit(0.0)) for c, (m, s) in zip(features, of, strict=True)])


def gram(rows: DataFrame, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of the logistic loss at w (the intercept first) over rows (x, y): one aggregate of a number a cell."""
    k = len(w)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + k + k * k)
        for batch in batches:
            y = batch.column("y").to_numpy()
            x = np.column_stack((np.ones(len(y)), batch.column("x").flatten().to_numpy().reshape(len(y), k - 1)))
            t = x @ w
            p = 1 / (1 + np.exp(-t))
            total += np.concatenate(([np.logaddexp(0, t).sum() - y @ t], x.T @ (p - y), ((x * (p * (1 - p))[:, None]).T @ x).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["cell", "value"])

    sums = np.zeros(1 + k + k * k)
    for r in rows.mapInArrow(part, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        sums[r["cell"]] = r["value"]
    return sums[0], sums[1 : k + 1], sums[k + 1 :].reshape(k, k)


def newton(rows: DataFrame, k: int, penalty: float, steps: int = 60, close: float = 1e-10) -> np.ndarray:
    """Intercept and weights that minimise the logistic loss of rows (x, y), summed, and half the penalty times the weights' squares.

    A step is one aggregate; one that does not lower the loss is halved."""
    ridge = penalty * np.append(0.0, np.ones(k))
    w, move, last = np.zeros(k + 1), np.zeros(k + 1), np.inf
    for _ in range(steps):
        loss, slope, curve = gram(rows, w)
        loss += ridge @ (w * w) / 2
        if loss > last + 1e-12 * abs(last):
            move /= 2
            w = w - move
        else:
            last = loss
            move = -np.linalg.solve(curve + np.diag(ridge) + 1e-12 * np.eye(k + 1), slope + ridge * w)
            w = w + move
        if np.abs(move).max() < close:
            break
    return w


def logistic(context_rows: DataFrame, c: float = 0.5, features: Sequence[str] = FEATURES, label: str = LABEL) -> Callable[[DataFrame], DataFrame]:
    """Standardised features and logistic regression by Newton steps; c as in a sum of losses, so that the penalty is 1 / c.

    Rows are scored by one expression."""
    of = moments(context_rows, features)
    known = cut(context_rows.where(F.col(label).isNotNull()).select(standardised(features, of).alias("x"), F.col(label).cast("double").alias("y")))
    w = newton(known, len(features), 1 / c)

    def score(rows: DataFrame) -> DataFrame:
        x, t = standardised(features, of), F.lit(float(w[0]))
        for i, v in enumerate(w[1:]):
            t = t + F.lit(float(v)) * x[i]
        return rows.select(*[f"`{c}`" for c in rows.columns], (1 / (1 + F.exp(-t))).alias("p"))

    score.weights = w
    return score


def kernel(context_rows: DataFrame, width: float = 0.5, features: Sequence[str] = FEATURES, label: str = LABEL, block: int = 1024) -> Callable[[DataFrame], DataFrame]:
    """In-context scoring: nothing is trained. A row attends to every row of the context, by exp(-d / (2 width^2)) of the mean squared
    distance d of their standardised features, and its probability is the mean label by these weights.

    The context goes to every task once its size is known to be within MOST_CONTEXT; rows come in Arrow batches and are compared in blocks."""
    known = context_rows.where(F.col(label).isNotNull())
    n = known.count()
    if not 0 < n <= MOST_CONTEXT:
        raise ValueError(f"the context has {n} labelled rows; 1 to {MOST_CONTEXT} can be attended to")
    of = moments(known, features)
    held = known.select(standardised(features, of).alias("x"), F.col(label).cast("double").alias("y")).toArrow()
    x = held.column("x").combine_chunks().flatten().to_numpy().reshape(n, len(features))
    carried = known.sparkSession.sparkContext.broadcast((x, held.column("y").to_numpy()))

    @F.pandas_udf("double")
    def attended(rows: pd.Series) -> pd.Series:
        x, y = carried.value
        out = [np.zeros(0)]
        for k in range(0, len(rows), block):
            q = np.stack(rows.iloc[k : k + block].to_numpy())
            near = (2 * q @ x.T - (q * q).sum(1)[:, None] - (x * x).sum(1)) / (2 * width * width * x.shape[1])
            near = np.exp(near - near.max(axis=1, keepdims=True))
            out.append(near @ y / near.sum(axis=1))
        return pd.Series(np.concatenate(out))

    def score(rows: DataFrame) -> DataFrame:
        return rows.select(*[f"`{c}`" for c in rows.columns], attended(standardised(features, of)).alias("p"))

    return score


def batched(predict: Callable) -> Scorer:
    """A scorer from a function (context as pandas) -> (features as pandas -> probabilities). The context is bounded by policy; rows come in batches."""

    def fit(context_rows: DataFrame) -> Callable[[DataFrame], DataFrame]:
        model = predict(context_rows.select(*FEATURES, LABEL).toPandas())

        def score(rows: DataFrame) -> DataFrame:
            def run(frames):
                for frame in frames:
                    yield frame.assign(p=model(frame[FEATURES]))

            return rows.mapInPandas(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "p double"]))

        return score

    return fit


@dataclass(frozen=True)
class Family:
    fit: Scorer
    #: Whether the cost of a row grows with the context.
    in_context: bool = False


FAMILIES: dict[str, Family] = {"stub": Family(logistic), "kernel": Family(kernel, in_context=True)}
#: What "auto" stands for on each kind of device.
AUTO = {"gpu": "kernel", "cpu": "stub"}


def device(spark: SparkSession) -> str:
    """gpu where the cluster gives tasks or executors any, else cpu."""
    amounts = [spark.conf.get(f"spark.{who}.resource.gpu.amount", "0") for who in ("task", "executor")]
    return "gpu" if any(float(a or 0) > 0 for a in amounts) else "cpu"


def resolved(family: str | None, on: str = "cpu") -> str:
    """The name of a family: "auto" (or none) by the kind of device, else as it is called, in any case of letters."""
    name = (family or "auto").lower()
    name = AUTO[on] if name == "auto" else name
    if name not in FAMILIES:
        raise ValueError(f"no scorer {family!r}; there are auto, {', '.join(sorted(FAMILIES))}")
    return name


def max_positives(context: dict, family: str, on: str = "cpu") -> int:
    """Positives of a context: the whole budget, but a quarter (or `max_mules_cpu`) for a family that attends to all of it without a GPU."""
    full = int(context["max_mules"])
    return int(context.get("max_mules_cpu", full // 4)) if on != "gpu" and family in FAMILIES and FAMILIES[family].in_context else full
