"""Customer segments: k-means over standardised features, named by business rules.

All numbers of clusters and all restarts are one run: every job carries the centres of all models that still move, adds up
their clusters' members, and each model stops on its own. First centres are drawn by k-means++: the row with the
smallest of exponential times at the rate of its squared distance is a draw by squared distance, so a draw is one minimum.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ordering import exact_percentiles
from tidemark.operators.evaluation import class_positions
from tidemark.operators.trees import added_up, draw
from tidemark.session import settle

# The ten inputs of the segmentation.
INPUTS = ["customer_tenure_days", "engagement_score", "watch_minutes_30d", "watch_minutes_change_pct_30d",
          "failed_payment_rate", "support_ticket_count_90d", "avg_customer_satisfaction",
          "negative_feedback_rate_180d", "customer_lifetime_value", "current_monthly_price"]


# The naming rules in order, each a name and its comparisons of a cluster's mean with the customers' median;
# every group of comparisons must hold in one of its members.
NAMING = [
    ("High-Value Loyal", [["customer_lifetime_value >= median"], ["engagement_score >= median"], ["failed_payment_rate <= median"]]),
    ("At-Risk Low-Engagement", [["engagement_score < median"], ["failed_payment_rate > median", "avg_customer_satisfaction < median"]]),
    ("New / Developing", [["customer_tenure_days < median"], ["customer_lifetime_value < median"]]),
    ("Billing-Fragile", [["failed_payment_rate > median"]]),
    ("Support-Intensive", [["support_ticket_count_90d > median"]]),
]
OTHERWISE = "Core Mainstream"

ITERATIONS, TOLERANCE = 300, 1e-4
BLOCK_ROWS = 50_000
SLICE_ROWS = 4_096  # rows of a block that are measured against the centres of all models at a time


# --- standardisation --------------------------------------------------------------------------------------------------

@dataclass
class Scaling:
    """Medians for missing values, means and population deviations of the filled columns."""

    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]

    def z(self, c: str):
        x = F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(self.medians.get(c, 0.0)))
        if not self.deviations.get(c):
            return F.lit(0.0)
        return (x - F.lit(self.means[c])) / F.lit(self.deviations[c])


def medians_of(features: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians from counts of distinct values; one row for each column comes to the driver."""
    long = features.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("double").alias("value"))
                                               for c in columns])).alias("x")).select("x.*")
    return {r["name"]: r["median"] for r in exact_percentiles(long, ["name"], "value", {"median": 0.5}).collect()}


def learn_scaling(features: DataFrame, columns: Sequence[str] = INPUTS) -> Scaling:
    medians = medians_of(features, columns)
    filled = features.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(medians.get(c, 0.0))).alias(c) for c in columns])
    r = filled.agg(*[F.avg(c).alias(f"a_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    return Scaling(medians, {c: r[f"a_{c}"] for c in columns}, {c: r[f"s_{c}"] for c in columns})


def z_scores(features: DataFrame, columns: Sequence[str] = INPUTS, scaling: Scaling | None = None) -> DataFrame:
    """Median-filled z-scores with the population deviation; a column without spread is 0."""
    scaling = scaling or learn_scaling(features, columns)
    return features.select("customer_id", *[scaling.z(c).alias(c) for c in columns])


# --- k-means, all models together -------------------------------------------------------------------------------------

@dataclass
class Centres:
    """One fitted model."""

    k: int
    restart: int
    points: np.ndarray
    cost: float
    iterations: int


def point_blocks(z: DataFrame, columns: Sequence[str] = INPUTS) -> RDD:
    """(key hashes, matrix) of the rows, written once."""
    rows = z.select(F.xxhash64("customer_id").alias("key"), *columns)
    parts = -(-rows.count() // BLOCK_ROWS) or 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            t = pa.Table.from_batches(held)
            block = t.column(0).to_numpy().view(np.uint64), np.column_stack([t.column(i).to_numpy() for i in range(1, t.num_columns)])
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], ["block"])

    written = settle(rows.repartition(parts, "key").mapInArrow(pack, "block binary"), "segment-blocks")
    return written.rdd.map(lambda r: pickle.loads(bytes(r["block"]))).persist(StorageLevel.MEMORY_AND_DISK)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(1)[:, None] + (centres ** 2).sum(1)[None, :] - 2 * x @ centres.T, 0)


def first_centres(blocks: RDD, models: Sequence[tuple[int, int]], seed: int) -> list[np.ndarray]:
    """k-means++ centres of every (k, restart): one job for each further centre, for all models at once."""
    held: list[list[np.ndarray]] = [[] for _ in models]

    def race(block: tuple, chosen: list[np.ndarray], wanted: list[int]) -> list[tuple]:
        key, x = block
        out = []
        for i in wanted:
            rate = _squares(x, chosen[i]).min(axis=1) if len(chosen[i]) else np.ones(len(x))
            waiting = -np.log1p(-draw(key, seed + 104_729 * i + len(chosen[i])))
            with np.errstate(divide="ignore", invalid="ignore"):
                time = np.where(rate > 0, waiting / rate, np.inf)
            at = int(np.lexsort((key, time))[0])
            out.append((float(time[at]), int(key[at]), x[at]))
        return out

    for step in range(max((k for k, _ in models), default=0)):
        wanted = [i for i, (k, _) in enumerate(models) if step < k]
        chosen = [np.array(c) for c in held]
        found = blocks.mapPartitions(lambda parts, a=chosen, w=wanted: [_first_of(race(b, a, w) for b in parts)]).treeReduce(_earlier)
        if found is None:
            return []
        for i, (_, _, x) in zip(wanted, found):
            held[i].append(x)
    return [np.array(c) for c in held]


def _earlier(a, b):
    if a is None or b is None:
        return b if a is None else a
    return [min(x, y, key=lambda r: r[:2]) for x, y in zip(a, b)]


def _first_of(found):
    best = None
    for f in found:
        best = _earlier(best, f)
    return best


def lloyd(blocks: RDD, models: Sequence[tuple[int, int]], starts: Sequence[np.ndarray], iterations: int = ITERATIONS,
          tolerance: float = TOLERANCE) -> list[Centres]:
    """Move the centres of all models until each has come to rest: squared moves together at most ``tolerance`` times the mean
    variance of the columns. A cluster without members keeps its centre. Costs are those of the final centres."""
    centres, used = [np.array(c) for c in starts], [0] * len(models)
    moving = list(range(len(models)))

    def members(block: tuple, at: list[np.ndarray]) -> np.ndarray:
        """For each centre of the given models: members, their sum and their cost."""
        return sum(slice_members(block[1][i:i + SLICE_ROWS], at) for i in range(0, len(block[1]), SLICE_ROWS))

    def slice_members(x: np.ndarray, at: list[np.ndarray]) -> np.ndarray:
        d = _squares(x, np.concatenate(at))
        out, first = [], 0
        for c in at:
            mine = d[:, first:first + len(c)]
            first += len(c)
            near = mine.argmin(axis=1)
            hit = np.zeros(mine.shape)
            hit[np.arange(len(x)), near] = 1
            out.append(np.column_stack([hit.sum(0), hit.T @ x, (hit * mine).sum(0)]))
        return np.concatenate(out)

    stats = added_up(blocks, lambda b: np.array([np.concatenate([[len(b[1])], b[1].sum(0), (b[1] ** 2).sum(0)])]))[0]
    n, d = stats[0], (len(stats) - 1) // 2
    limit = tolerance * float(np.mean(stats[1 + d:] / n - (stats[1:1 + d] / n) ** 2))
    for _ in range(iterations):
        if not moving:
            break
        at = [centres[i] for i in moving]
        found, first, still = added_up(blocks, lambda b, at=at: members(b, at)), 0, []
        for i in moving:
            mine = found[first:first + len(centres[i])]
            first += len(centres[i])
            new = np.where(mine[:, :1] > 0, mine[:, 1:1 + d] / np.maximum(mine[:, :1], 1), centres[i])
            moved = float(((new - centres[i]) ** 2).sum())
            centres[i], used[i] = new, used[i] + 1
            if moved > limit:
                still.append(i)
        moving = still
    final, first, out = added_up(blocks, lambda b, at=centres: members(b, at)), 0, []
    for (k, restart), c, steps in zip(models, centres, used):
        out.append(Centres(k, restart, c, float(final[first:first + k, -1].sum()), steps))
        first += k
    return out


def fit_kmeans(blocks: RDD, ks: Sequence[int], restarts: int, seed: int = 42) -> dict[int, Centres]:
    """For each k the restart with the lowest cost."""
    models = [(k, r) for k in ks for r in range(restarts)]
    starts = first_centres(blocks, models, seed)
    if not starts:
        return {}
    best: dict[int, Centres] = {}
    for found in lloyd(blocks, models, starts):
        if found.k not in best or found.cost < best[found.k].cost:
            best[found.k] = found
    return best


def nearest(z: DataFrame, centres: np.ndarray, out: str = "cluster_id", columns: Sequence[str] = INPUTS) -> DataFrame:
    """Add the number of the nearest centre (ties to the first)."""
    points = [[float(v) for v in c] for c in centres]
    apart = [sum(((F.col(c) - F.lit(v)) * (F.col(c) - F.lit(v)) for c, v in zip(columns, p)), F.lit(0.0)) for p in points]
    place = F.array_position(F.array(*[F.col(f"_d{i}") for i in range(len(points))]), F.least(*[F.col(f"_d{i}") for i in range(len(points))])
                             if len(points) > 1 else F.col("_d0"))
    return z.withColumns({f"_d{i}": a for i, a in enumerate(apart)}).withColumn(out, (place - 1).cast("int")).drop(*[f"_d{i}" for i in range(len(points))])


# --- silhouette -------------------------------------------------------------------------------------------------------

def silhouettes(z: DataFrame, models: Mapping[int, np.ndarray], size: int = 5000, seed: int = 42,
                columns: Sequence[str] = INPUTS) -> dict[int, float]:
    """Euclidean silhouette of each model over one repeatable sample: the first ``size`` rows in the order of their key's hash.

    The sample (bounded by ``size``) is shipped to every task; each of its rows is measured against all of it, for all models.
    """
    placed = class_positions(z, "customer_id", None, seed, "_position").where(F.col("_position") < size).drop("_position")
    sample = settle(placed.select(*columns), "silhouette-sample")
    kept = sample.toPandas()  # at most ``size`` rows
    if kept.empty:
        return {k: 0.0 for k in models}
    points = kept.to_numpy(np.float64)
    labels = {k: _squares(points, c).argmin(axis=1) for k, c in models.items()}
    shared = z.sparkSession.sparkContext.broadcast((points, labels, dict(models)))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        everything, cluster, centres = shared.value
        for batch in batches:
            mine = batch.to_numpy(np.float64)
            apart = np.sqrt(_squares(mine, everything))
            for k, c in centres.items():
                names, sizes = np.unique(cluster[k], return_counts=True)
                own = np.searchsorted(names, _squares(mine, c).argmin(axis=1))
                sums = np.column_stack([apart[:, cluster[k] == name].sum(1) for name in names])
                rows = np.arange(len(mine))
                inside = sums[rows, own] / np.maximum(sizes[own] - 1, 1)
                means = sums / sizes
                means[rows, own] = np.inf
                outside = means.min(1)
                lone = (sizes[own] == 1) | ~np.isfinite(outside)
                score = np.where(lone, 0.0, (np.where(lone, 0.0, outside) - inside) / np.maximum(np.maximum(inside, np.where(lone, 1.0, outside)), 1e-300))
                yield pd.DataFrame({"k": k, "s": score})

    slices = sample.repartition(z.sparkSession.sparkContext.defaultParallelism)
    return {r["k"]: r["s"] for r in slices.mapInPandas(measure, "k int, s double").groupBy("k").agg(F.avg("s").alias("s")).collect()}


# --- profiles and names -----------------------------------------------------------------------------------------------

def profiles(clustered: DataFrame, cluster: str = "cluster_id", columns: Sequence[str] = INPUTS) -> DataFrame:
    """M23"""
    return clustered.groupBy(cluster).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns],
                                          F.count(F.lit(1)).alias("customer_count"))


def name_segments(profile: DataFrame, features: DataFrame, cluster: str = "cluster_id", medians: Mapping[str, float] | None = None) -> DataFrame:
    """The first rule that holds names the cluster; a comparison with a missing mean or median does not hold."""
    medians = medians or medians_of(features, INPUTS)

    def holds(comparison: str):
        column, sign, _ = comparison.split()
        mean, median = F.col(column), F.lit(medians.get(column)).cast("double")
        return {">=": mean >= median, "<=": mean <= median, ">": mean > median, "<": mean < median}[sign]

    label = F
    for name, groups in NAMING:
        rule = F.lit(True)
        for group in groups:
            one = F.lit(False)
            for comparison in group:
                one = one | F.coalesce(holds(comparison), F.lit(False))
            rule = rule & one
        label = label.when(rule, name)
    named = F.concat(label.otherwise(OTHERWISE), F.lit(" (C"), F.col(cluster).cast("string"), F.lit(")"))
    return profile.withColumn("cluster_name", named).select(*profile.columns, "cluster_name")


# --- plane ------------------------------------------------------------------------------------------------------------

def loadings(blocks: RDD) -> np.ndarray:
    """Two principal components of the centred points; each is signed so that its largest loading is positive."""
    def moments(block: tuple) -> np.ndarray:
        x = block[1]
        return np.column_stack([x.sum(0), x.T @ x, np.full(x.shape[1], len(x))])

    sums = added_up(blocks, moments)
    n, mean = sums[0, -1], sums[:, 0] / sums[0, -1]
    _, vectors = np.linalg.eigh(sums[:, 1:-1] / n - np.outer(mean, mean))
    two = vectors[:, ::-1][:, :2]
    return two * np.where(two[np.abs(two).argmax(axis=0), np.arange(two.shape[1])] < 0, -1.0, 1.0)


def plane_coordinates(z: DataFrame, axes: np.ndarray, columns: Sequence[str] = INPUTS) -> DataFrame:
    """Add pca_1 and pca_2 of z-scores, whose means are 0."""
    spots = {f"pca_{i + 1}": sum((F.col(c) * F.lit(float(w)) for c, w in zip(columns, axes[:, i])), F.lit(0.0)) for i in range(axes.shape[1])}
    return z.withColumns(spots)


# --- the whole segmentation -------------------------------------------------------------------------------------------

@dataclass
class SegmentModel:
    """What places a customer: saved as one JSON document."""

    scaling: Scaling
    best_k: int
    silhouette_scores: dict[int, float]
    centres: list[list[float]]
    axes: list[list[float]]
    names: dict[int, str]
    features: list[str]

    def place(self, features: DataFrame) -> DataFrame:
        """customer_id, the inputs, cluster_id, cluster_name and plane coordinates of any customers."""
        z = z_scores(features, self.features, self.scaling)
        spotted = plane_coordinates(nearest(z, np.array(self.centres), columns=self.features), np.array(self.axes), self.features)
        name = F.create_map(*[F.lit(x) for pair in self.names.items() for x in pair])[F.col("cluster_id")]
        placed = spotted.select("customer_id", "cluster_id", name.alias("cluster_name"), *[f"pca_{i + 1}" for i in range(len(self.axes[0]))])
        return features.select("customer_id", *self.features).join(placed, "customer_id")

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps(asdict(self))
        spark.range(1).select(F.lit(text).alias("value")).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SegmentModel:
        held = json.loads(spark.read.text(path).first()["value"])
        whole = {name: {int(k): v for k, v in held[name].items()} for name in ("silhouette_scores", "names")}
        return cls(**(held | whole | {"scaling": Scaling(**held["scaling"])}))


@dataclass
class Segments:
    model: SegmentModel
    customers: DataFrame
    profiles: DataFrame

    @property
    def best_k(self) -> int:
        return self.model.best_k

    @property
    def silhouettes(self) -> dict[int, float]:
        return self.model.silhouette_scores


def segment_customers(features: DataFrame, ks: Sequence[int] = range(2, 8), restarts: int = 30) -> Segments:
    """The k with the largest silhouette wins (ties to the smaller)."""
    scaling = learn_scaling(features)
    z = settle(z_scores(features, INPUTS, scaling), "segment-vectors")
    blocks = point_blocks(z)
    models = fit_kmeans(blocks, ks, restarts)
    scores = silhouettes(z, {k: m.points for k, m in models.items()})
    best = max(sorted(scores), key=scores.get)
    axes = loadings(blocks)
    blocks.unpersist()
    placed = settle(nearest(z, models[best].points).select("customer_id", "cluster_id"), "segment-places")
    profile = profiles(features.select("customer_id", *INPUTS).join(placed, "customer_id"))
    named = name_segments(profile, features, medians=scaling.medians)
    names = {r["cluster_id"]: r["cluster_name"] for r in named.select("cluster_id", "cluster_name").collect()}  # one row a cluster
    model = SegmentModel(scaling, best, scores, models[best].points.tolist(), axes.tolist(), names, list(INPUTS))
    return Segments(model, model.place(features), named)
