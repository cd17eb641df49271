"""Deterministic K-Means: all restarts and all K of a sweep advance together.

Every iteration is one job over one scan of the features, whatever the number
of runs: a task assigns its rows to the nearest centroid of each run and hands
on one row of sums per (run, cluster), which are added up after a shuffle of
runs x clusters x partitions small rows. Only centroids reach the driver.

Seeding is k-means++ with random numbers taken from a hash of the key: the
first centre of restart r is the row with the smallest number, every further
one the row with the smallest ``-ln(u) / d``, d its squared distance from the
nearest centre so far. That is a draw in proportion to d, the same on every
run and every engine. The centres of a run with fewer clusters are the first
ones of the same restart's sequence.

A run ends when none of its centroids moves by more than ``tolerance``.
Clusters are numbered by their centroids' coordinates, so restarts that end in
the same partition give the same numbers; the best restart has the lowest cost
rounded to 9 decimals, ties go to the first.

NULL features are not expected (``rfm_scaled`` drops them). Fewer distinct
rows than clusters leave clusters without rows out of the result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import ClusterParams
from ..session import cut_lineage

TOLERANCE = 1e-9
TWO32 = 4294967296.0


@dataclass(frozen=True)
class Run:
    """One finished run: centroids, sizes and costs of the clusters in the
    order of their numbers."""
    k: int
    restart: int
    cost: float
    iterations: int
    centroids: tuple[tuple[float, ...], ...]
    sizes: tuple[int, ...]
    costs: tuple[float, ...]


def _matrix(batch: pa.RecordBatch, cols: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols], axis=1).astype(np.float64)


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, summed dimension by dimension."""
    out = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        d = x[:, j, None] - centres[None, :, j]
        out += d * d
    return out


def closest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the number of the nearest centre (ties: the smaller number) and
    its squared distance, those of ``squares``. Centre by centre over columns
    that lie in one piece: no rows x centres table, no search along short rows."""
    columns = np.ascontiguousarray(x.T)
    near, best = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf)
    for i, centre in enumerate(centres):
        d = np.zeros(len(x))
        for column, at in zip(columns, centre):
            e = column - at
            d += e * e
        near[d < best] = i
        best = np.minimum(d, best)
    return near, best


def uniforms(features: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The key and the features, written once. The random number of restart r
    and step t comes from md5(key | seed + r | t)."""
    return cut_lineage(features.select(F.col(key).cast("string").alias("key"), *[F.col(c).cast("double").alias(c) for c in columns]))


def seeds(points: DataFrame, columns: list[str], k_max: int, p: ClusterParams) -> list[np.ndarray]:
    """Per restart the sequence of up to ``k_max`` centres; one job a step."""
    chosen: list[list[tuple[float, ...]]] = [[] for _ in range(max(1, p.restarts))]
    for step in range(k_max):
        centres = [np.array(c).reshape(-1, len(columns)) for c in chosen]

        def best(batches, centres=centres, step=step):
            from hashlib import md5
            top: list[tuple] = [(np.inf, "", ())] * len(centres)
            for b in batches:
                keys, x = b.column("key").to_pylist(), _matrix(b, columns)
                for r, c in enumerate(centres):
                    u = np.array([int(md5(f"{k}|{p.seed + r}|{step}".encode()).hexdigest()[:8], 16) for k in keys]) / TWO32
                    race = u
                    if len(c):
                        d = squares(x, c).min(axis=1)
                        with np.errstate(divide="ignore", invalid="ignore"):
                            race = np.where(d > 0, -np.log((u * TWO32 + 0.5) / TWO32) / d, np.inf)
                    for i in np.flatnonzero(race == race.min())[:1] if len(race) else []:
                        ties = np.flatnonzero(race == race[i])
                        i = min(ties, key=lambda t: keys[t])
                        top[r] = min(top[r], (float(race[i]), keys[i], tuple(x[i].tolist())))
            found = [(r, *t) for r, t in enumerate(top) if np.isfinite(t[0])]
            yield pa.RecordBatch.from_pylist([{"r": r, "race": a, "key": k, "x": list(v)} for r, a, k, v in found],
                                             pa.schema([("r", pa.int32()), ("race", pa.float64()), ("key", pa.string()), ("x", pa.list_(pa.float64()))]))

        won = (points.mapInArrow(best, "r int, race double, key string, x array<double>")
                     .groupBy("r").agg(F.min_by("x", F.struct("race", "key")).alias("x")).collect())   # one row per restart
        for row in won:
            chosen[row["r"]].append(tuple(row["x"]))
    return [np.array(c).reshape(-1, len(columns)) for c in chosen]


def _advance(points: DataFrame, columns: list[str], centroids: dict[tuple[int, int], np.ndarray]) -> dict[tuple[int, int], tuple]:
    """Per run: members, sums and cost of each cluster. One job."""
    runs = list(centroids.items())

    def sums(batches):
        size = [np.zeros(len(c)) for _, c in runs]
        total = [np.zeros((len(c), len(columns))) for _, c in runs]
        cost = [np.zeros(len(c)) for _, c in runs]
        for b in batches:
            x = _matrix(b, columns)
            if not len(x):
                continue
            for i, (_, c) in enumerate(runs):
                near, d = closest(x, c)
                cost[i] += np.bincount(near, weights=d, minlength=len(c))
                size[i] += np.bincount(near, minlength=len(c))
                for j in range(len(columns)):
                    total[i][:, j] += np.bincount(near, weights=x[:, j], minlength=len(c))
        rows = [{"run": i, "cluster": c, "n": float(size[i][c]), "s": total[i][c].tolist(), "cost": float(cost[i][c])}
                for i in range(len(runs)) for c in range(len(size[i]))]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("run", pa.int32()), ("cluster", pa.int32()), ("n", pa.float64()),
                                                          ("s", pa.list_(pa.float64())), ("cost", pa.float64())]))

    got = (points.mapInArrow(sums, "run int, cluster int, n double, s array<double>, cost double").groupBy("run", "cluster")
                 .agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(len(columns))])
                 .collect())                                # runs x clusters rows
    out = {}
    for i, (name, c) in enumerate(runs):
        mine = sorted((r for r in got if r["run"] == i), key=lambda r: r["cluster"])
        out[name] = (np.array([r["n"] for r in mine]), np.array([[r[f"s{j}"] for j in range(len(columns))] for r in mine]), np.array([r["cost"] for r in mine]))
    return out


def fit(points: DataFrame, columns: list[str], ks: list[int], p: ClusterParams = ClusterParams()) -> dict[int, Run]:
    """The best of ``p.restarts`` runs per K. ``points``: key and features
    (see ``uniforms``); it is read once per iteration."""
    start = seeds(points, columns, max(ks), p)
    live = {(k, r): c[:k].copy() for k in ks for r, c in enumerate(start) if len(c)}
    done: dict[tuple[int, int], Run] = {}
    for step in range(p.max_iter + 1):
        if not live:
            break
        sums = _advance(points, columns, live)
        for name, c in list(live.items()):
            n, s, cost = sums[name]
            new = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c)
            if np.abs(new - c).max() <= TOLERANCE or step == p.max_iter:
                kept = sorted((tuple(v), int(m), float(w)) for v, m, w in zip(c.tolist(), n, cost) if m > 0)
                done[name] = Run(name[0], name[1], float(cost.sum()), step, *zip(*kept))
                del live[name]
            else:
                live[name] = new
    best: dict[int, Run] = {}
    for (k, _), run in sorted(done.items()):
        if k not in best or round(run.cost, 9) < round(best[k].cost, 9):
            best[k] = run
    return best


def nearest(columns: list[str], run: Run):
    """Column: number of the nearest centroid (ties: the smaller one)."""
    def d(c):
        terms = [(F.col(z) - F.lit(v)) * (F.col(z) - F.lit(v)) for z, v in zip(columns, c)]
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out
    return F.array_min(F.array(*[F.struct(d(c).alias("d"), F.lit(i).alias("k")) for i, c in enumerate(run.centroids)]))["k"]


def silhouettes(points: DataFrame, columns: list[str], best: dict[int, Run]) -> dict[int, float]:
    """Mean squared-Euclidean silhouette per K. The mean squared distance of a
    row from a cluster is its squared distance from the centroid plus the
    cluster's cost per row, so one job over the rows does for all K."""
    runs = list(best.values())

    def sums(batches):
        total = np.zeros(len(runs))
        rows = 0
        for b in batches:
            x = _matrix(b, columns)
            rows += len(x)
            for i, run in enumerate(runs if len(x) else []):
                n = np.array(run.sizes, dtype=np.float64)
                d = squares(x, np.array(run.centroids))
                near = d.argmin(axis=1)
                if len(n) < 2:
                    continue
                at = np.arange(len(x))
                d += np.array(run.costs) / n
                own = d[at, near] * (n / np.maximum(n - 1, 1))[near]      # a row is not compared with itself
                d[at, near] = np.inf
                other = d.min(axis=1)
                top = np.maximum(own, other)
                good = (n[near] > 1) & (top > 0)
                total[i] += ((other - own)[good] / top[good]).sum()
        yield pa.RecordBatch.from_arrays([pa.array(list(range(len(runs))), pa.int32()), pa.array(total), pa.array([rows] * len(runs), pa.int64())],
                                         names=["run", "s", "n"])

    got = points.mapInArrow(sums, "run int, s double, n long").groupBy("run").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    return {runs[r["run"]].k: r["s"] / r["n"] if r["n"] else 0.0 for r in got}
