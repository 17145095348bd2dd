"""Forecast training on feature rows: chronological split, baselines, linear and boosted models."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.aggregate import error_metrics

LEAST_ROWS = 200


def instant_at(df: DataFrame, ts: str, share: float) -> int | None:
    """The least instant, in microseconds, up to which at least that share of the rows with one lies; None without rows.

    Found in days, then in the seconds of one day, then in the microseconds of one second: what is
    counted and reaches the driver is bounded by time, not by rows, and nothing is sorted.
    """
    at = df.select(F.unix_micros(F.col(ts).cast("timestamp")).alias("t")).where("t is not null")
    left, low = None, None
    for width in (86_400_000_000, 1_000_000, 1):
        counts = sorted((r[0], r[1]) for r in at.groupBy(F.floor(F.col("t") / width)).count().collect())
        if left is None:
            if not counts:
                return None
            left = max(1, math.ceil(share * sum(c for _, c in counts)))
        for low, c in counts:
            if left <= c:
                break
            left -= c
        at = at.where(F.col("t").between(low * width, (low + 1) * width - 1))
    return low


def split(df: DataFrame, ts: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Rows before and from the instant_at() of a share; rows without an instant are in neither."""
    cut = instant_at(df, ts, share)
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    return df.where(t < F.lit(cut)), df.where(t >= F.lit(cut))


def evaluate(df: DataFrame, actual: str, predicted: str) -> dict[str, float]:
    return df.agg(*error_metrics(actual, predicted)).first().asDict()


def train(df: DataFrame, ts: str, features: Sequence[str], target: str, baselines: Sequence[str], trees: int = 300, depth: int = 5, seed: int = 42) -> dict:
    """Errors of baselines and models on the last fifth, best first, and the boosted model's largest importances."""
    rows = df.dropna(subset=[*features, target])
    if rows.count() < LEAST_ROWS:
        raise ValueError(f"fewer than {LEAST_ROWS} complete rows")
    train_rows, test_rows = split(rows, ts)
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw_")
    scaler = StandardScaler(inputCol="raw_", outputCol="x_", withMean=True).fit(assembler.transform(train_rows))
    ready = lambda d: scaler.transform(assembler.transform(d))
    fit_rows, test = ready(train_rows), ready(test_rows)
    n = train_rows.count()
    # The penalty counts against the mean of squares here, against their sum in other libraries.
    models = {
        "ridge": LinearRegression(featuresCol="x_", labelCol=target, predictionCol="p_", regParam=1.0 / n, elasticNetParam=0.0).fit(fit_rows),
        "boosted": GBTRegressor(featuresCol="x_", labelCol=target, predictionCol="p_", maxIter=trees, maxDepth=depth, stepSize=0.05, subsamplingRate=0.9, seed=seed).fit(fit_rows),
    }
    results = {b: evaluate(test_rows.where(F.col(b).isNotNull()), target, b) for b in baselines}
    results |= {name: evaluate(m.transform(test), target, "p_") for name, m in models.items()}
    weights = models["boosted"].featureImportances.toArray().tolist()
    top = sorted(zip(features, weights, strict=True), key=lambda x: -x[1])[:8]
    return {"results": dict(sorted(results.items(), key=lambda x: x[1]["mae"])), "importances": dict(top)}


def save(metrics: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(metrics, f, indent=1)
