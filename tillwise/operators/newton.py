"""Logistic regression by Newton's method on distributed rows.

One iteration is one job: a task turns its rows into the weighted Gram matrix,
the gradient and the loss of every model that is being fitted (15 x 15 + 15 + 1
numbers for 14 features and an intercept), which are added up cell by cell.
The driver solves one small linear system per model and sends the coefficients
back. Cross-validation folds are further models over the same rows, each
leaving one fold out, so all of them share the scan of every iteration.

The objective is that of L2-penalised logistic regression with strength
``1 / c``: ``|w|^2 / 2 + c * sum(weight * loss)``, the intercept free. It is
strictly convex, so the result does not depend on order, partitions or engine.
A step that raises the loss is halved.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FULL = -1          # the model of all rows; others are named by the fold they leave out
TOLERANCE = 1e-10
SMALLEST_STEP = 2.0 ** -20


def _sums(rows: DataFrame, columns: list[str], label: str, weight: str, fold: str | None, betas: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    size = len(columns) + 1
    names = list(betas)

    def run(batches):
        total = {m: np.zeros(size * size + size + 1) for m in names}
        for b in batches:
            x = np.stack([np.ones(b.num_rows), *[b.column(c).to_numpy(zero_copy_only=False) for c in columns]], axis=1).astype(np.float64)
            y = b.column("_y").to_numpy(zero_copy_only=False).astype(np.float64)
            w0 = b.column("_w").to_numpy(zero_copy_only=False).astype(np.float64)
            f = b.column("_f").to_numpy(zero_copy_only=False)
            for m in names:
                w = w0 if m == FULL else np.where(f == m, 0.0, w0)
                z = x @ betas[m]
                p = 1.0 / (1.0 + np.exp(-z))
                loss = np.logaddexp(0.0, z) - y * z
                total[m] += np.concatenate([((x * (w * p * (1.0 - p))[:, None]).T @ x).ravel(), x.T @ (w * (p - y)), [w @ loss]])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([total[m].tolist() for m in names], pa.list_(pa.float64()))], names=["m", "v"])

    src = rows.select(*[F.col(c).cast("double").alias(c) for c in columns], F.col(label).cast("double").alias("_y"),
                      F.col(weight).cast("double").alias("_w"), (F.col(fold).cast("int") if fold else F.lit(None).cast("int")).alias("_f"))
    src = src.withColumn("_f", F.coalesce("_f", F.lit(FULL)))
    cells = src.mapInArrow(run, "m int, v array<double>").select("m", F.posexplode("v")).groupBy("m", "pos").agg(F.sum("col").alias("v"))
    out = {m: np.zeros(size * size + size + 1) for m in names}
    for r in cells.collect():                       # models x 241 numbers
        out[r["m"]][r["pos"]] = r["v"]
    return out


def fit(rows: DataFrame, columns: Sequence[str], label: str, weight: str, c: float = 1.0, fold: str | None = None,
        folds: Sequence[int] = (), max_iter: int = 100) -> dict[int, np.ndarray]:
    """Coefficients per model, the intercept first: ``FULL`` over all rows and,
    for each number in ``folds``, the model without the rows of that fold.
    ``rows`` is read once per iteration; pass a written table. No rows: zeros."""
    columns = list(columns)
    size = len(columns) + 1
    free = np.ones(size)
    free[0] = 0.0                                    # the intercept is not penalised
    betas = {m: np.zeros(size) for m in (FULL, *folds)}
    loss = dict.fromkeys(betas, np.inf)
    origin = {m: b.copy() for m, b in betas.items()}
    step: dict[int, np.ndarray] = {}
    scale = dict.fromkeys(betas, 1.0)
    live = set(betas)
    for _ in range(max_iter):
        if not live:
            break
        sums = _sums(rows, columns, label, weight, fold, {m: betas[m] for m in sorted(live)})
        for m, v in sums.items():
            b = betas[m]
            now = c * v[-1] + 0.5 * float((free * b * b).sum())
            if now > loss[m] + 1e-12 * abs(loss[m]) and scale[m] > SMALLEST_STEP:
                scale[m] /= 2                        # too far: back half the way
                betas[m] = origin[m] - scale[m] * step[m]
                continue
            hessian = c * v[:size * size].reshape(size, size) + np.diag(free)
            gradient = c * v[size * size:-1] + free * b
            if not v[:size * size].any():            # no rows
                live.discard(m)
                continue
            step[m] = np.linalg.solve(hessian, gradient)
            loss[m], origin[m], scale[m] = now, b, 1.0
            betas[m] = b - step[m]
            if np.abs(step[m]).max() <= TOLERANCE:
                live.discard(m)
    return betas


def probability(columns: Sequence[str], beta: np.ndarray) -> Column:
    z = F.lit(float(beta[0]))
    for name, w in zip(columns, beta[1:]):
        z = z + F.lit(float(w)) * F.col(name)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
