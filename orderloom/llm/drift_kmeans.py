"""Centroid clustering with geometric tightening of drifts.

Exact Lloyd rounds. Each vector keeps its cluster, an upper bound of the distance to its own centroid
and one lower bound of the distance to every other. When centroids move, the upper bound grows
by its own centroid's drift. The lower bound would have to shrink by the largest drift; it shrinks
by less: all vectors of a cluster lie in a sphere around its old centroid whose radius is the
largest upper bound among them, and what counts is how much nearer a moved centroid can have come to
any point of that sphere. A vector whose bounds overlap has its own distance computed; if they still
overlap, all distances. Bounds decide only with a margin, so ties are always computed exactly.

The planar bound. Let a centroid move from f to g, u be the direction and p the length of its way,
and m, R be the sphere. For a point x, d(x,f) - d(x,g) is the integral over s from 0 to p of the
cosine of the angle between u and x - (f + s u). Seen from f + s u, the sphere's centre stands at an
angle b(s) from u, and its points at most asin(R / distance) to either side, all in the plane of f, g
and m. So the cosine is at most cos(max(0, b - asin(...))), or 1 inside the sphere. It never grows
with s, so sums over pieces with the value at each piece's start bound the integral from above. The
result is at most p, and negative where the centroid has left: the lower bound then rises.

Defined results: rows whose vector is NULL, of another length, or holds NULL, NaN or infinity are left
out; repeated rows and repeated or NULL ids count each for itself; vectors at equal distance go to the smaller
number; fewer vectors than clusters give as many clusters as vectors; a cluster that loses all its
vectors stays where it is; an empty table gives no rows. Other columns are ignored. Components must
stay below 2**27 once scaled; larger ones raise an error.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import vector_blocks as blocks

PIECES = 16
# Distances are sums of up to a few hundred exact squares: relative errors are near 1e-16.
MARGIN = 1e-9

_MOVED = "array<struct<cluster:int,n:long,sums:array<long>,radius:double,inertia:long>>"
_MOVED_TYPE = pa.struct(
    [
        ("cluster", pa.int32()),
        ("n", pa.int64()),
        ("sums", pa.list_(pa.int64())),
        ("radius", pa.float64()),
        ("inertia", pa.int64()),
    ]
)
_STATE = f"cluster binary, upper binary, lower binary, n_scanned long, moved {_MOVED}"
_RESULT = f"clusters array<int>, distances array<long>, n_scanned long, moved {_MOVED}"


def approach(spheres: np.ndarray, radii: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """[i, j]: a bound of how much nearer any point of sphere i has come to centroid j by its move.

    At most the length of the move, and negative where the centroid has gone away from the sphere.
    """
    way = new - old
    length = np.sqrt((way * way).sum(1))
    unit = way / np.where(length > 0, length, 1)[:, None]
    # The plane: `along` the way from the old place, and `aside` from its line.
    apart = spheres[:, None, :] - old[None, :, :]
    along = (apart * unit[None, :, :]).sum(2)
    aside = np.sqrt(np.maximum(0, (apart * apart).sum(2) - along * along))
    total = np.zeros_like(along)
    for piece in range(PIECES):
        ahead = along - length[None, :] * (piece / PIECES)
        far = np.hypot(ahead, aside)
        half = np.arcsin(np.minimum(1, radii[:, None] / np.where(far > 0, far, 1)))
        angle = np.maximum(0, np.arctan2(aside, ahead) - half)
        total += np.where(far <= radii[:, None], 1.0, np.cos(angle))
    bound = length[None, :] * np.minimum(1, total / PIECES + MARGIN)
    return np.where(length[None, :] > 0, bound, 0.0)


def loosening(spheres: np.ndarray, radii: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """By how much the lower bounds of each cluster must shrink: its own centroid does not count."""
    nearer = approach(spheres, radii, old, new)
    np.fill_diagonal(nearer, -np.inf)
    return nearer.max(1) if len(old) > 1 else np.zeros(1)


@dataclass(frozen=True)
class Model:
    """Centroids of one round, and what the move to them does to the bounds."""

    centers: np.ndarray
    drift: np.ndarray | None = None
    loosen: np.ndarray | None = None


def _assigned(vectors: np.ndarray, state: dict | None, model: Model):
    """Clusters, bounds and the clusters before, and how many vectors needed all distances."""
    centers, count = model.centers, len(vectors)
    if state is None:
        before = np.full(count, -1, np.int32)
        cluster, doubtful = before.copy(), np.arange(count)
        upper, lower = np.zeros(count), np.zeros(count)
    else:
        before = np.frombuffer(state["cluster"], np.int32)
        cluster = before.copy()
        upper = np.frombuffer(state["upper"], np.float64) + model.drift[before]
        lower = np.frombuffer(state["lower"], np.float64) - model.loosen[before]

        def clear(rows):
            return upper[rows] * (1 + MARGIN) + MARGIN < lower[rows]

        doubtful = np.flatnonzero(~clear(np.arange(count)))
        upper[doubtful] = np.sqrt(blocks.squared_own(vectors[doubtful], centers[cluster[doubtful]]))
        doubtful = doubtful[~clear(doubtful)]
    if len(doubtful):
        squares = blocks.squared_to(vectors[doubtful], centers)
        own = squares.argmin(1)
        cluster[doubtful] = own
        upper[doubtful] = np.sqrt(squares[np.arange(len(own)), own])
        squares[np.arange(len(own)), own] = np.iinfo(np.int64).max
        lower[doubtful] = np.sqrt(squares.min(1)) if len(centers) > 1 else np.inf
    return before, cluster, upper, lower, len(doubtful)


def _moves(vectors, before, cluster, upper, distances=None) -> pa.Array:
    """Per cluster: vectors and sums that came less those that went, the radius, the inertia."""
    rows = []
    for number in np.union1d(before, cluster):
        if number < 0:
            continue
        here = cluster == number
        came, went = here & (before != number), ~here & (before == number)
        sums = vectors[came].sum(0, dtype=np.int64) - vectors[went].sum(0, dtype=np.int64)
        rows.append(
            {
                "cluster": int(number),
                "n": int(came.sum() - went.sum()),
                "sums": sums.tolist(),
                "radius": float(upper[here].max(initial=0.0)),
                "inertia": 0 if distances is None else int(distances[here].sum()),
            }
        )
    return pa.array([rows], pa.list_(_MOVED_TYPE))


def _round(model: Model):
    def step(vectors: np.ndarray, state: dict | None) -> dict:
        before, cluster, upper, lower, scanned = _assigned(vectors, state, model)
        return {
            "cluster": cluster.astype(np.int32).tobytes(),
            "upper": upper.tobytes(),
            "lower": lower.tobytes(),
            "n_scanned": scanned,
            "moved": _moves(vectors, before, cluster, upper),
        }

    return step


def _last_round(model: Model):
    def step(vectors: np.ndarray, state: dict | None) -> dict:
        before, cluster, upper, _, scanned = _assigned(vectors, state, model)
        distances = blocks.squared_own(vectors, model.centers[cluster])
        return {
            "clusters": blocks.listed(cluster.astype(np.int32)),
            "distances": blocks.listed(distances),
            "n_scanned": scanned,
            "moved": _moves(vectors, before, cluster, upper, distances),
        }

    return step


def _totals(state: DataFrame, dim: int) -> list:
    """One row per cluster: bounded by the number of clusters."""
    moved = state.select(F.inline("moved"))
    sums = F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(dim)]).alias("sums")
    totals = [F.sum("n").alias("n"), sums, F.max("radius").alias("radius"), F.sum("inertia").alias("inertia")]
    return moved.groupBy("cluster").agg(*totals).collect()


def starting_vectors(rows: DataFrame, id_column: str, vector: str, clusters: int, salt: str) -> DataFrame:
    """The rows with the smallest SHA-256 of the salted id; ties by the vector."""
    salted = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return rows.orderBy(F.sha2(salted, 256), vector).limit(clusters).select(vector)


def cluster(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    clusters: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    dim: int = 64,
    salt: str = "3",
    watch: list | None = None,
) -> DataFrame:
    """Per vector: its id, cluster, squared distance, the sums of these, its centroid's hash.

    `watch` collects how many vectors each round had to compare with all centroids.
    """
    spark = rows.sparkSession
    kept = rows.select(id_column, vector).where((F.size(vector) == dim) & blocks.finite(F.col(vector)))
    first = starting_vectors(kept, id_column, vector, clusters, salt).collect()
    names = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    kind = rows.schema[id_column].dataType.simpleString()
    if not first:
        return spark.createDataFrame([], f"`{id_column}` {kind}, {names}")
    starts = np.array([row[0] for row in first], np.float64).reshape(len(first), dim)
    centers = blocks.to_integers(starts, scale).astype(np.int64)

    buckets = blocks.buckets_for(rows, rows.count())
    data = blocks.packed(kept, vector, scale, dim, buckets, id_column)
    keeper = blocks.Rounds(data, buckets, dim)
    model = Model(centers)
    counts = [0] * len(centers)
    sums = [[0] * dim for _ in centers]
    bounds = ("cluster", "upper", "lower")
    for number in range(rounds):
        state = keeper.advance(_round(model), _STATE, bounds if number else ())
        radii = np.zeros(len(centers))
        for row in _totals(state, dim):
            counts[row["cluster"]] += row["n"]
            sums[row["cluster"]] = [a + b for a, b in zip(sums[row["cluster"]], row["sums"])]
            radii[row["cluster"]] = row["radius"]
        if watch is not None:
            watch.append(state.agg(F.sum("n_scanned")).first()[0])
        old = model.centers
        new = np.array(
            [[s // n for s in total] if n else list(at) for total, n, at in zip(sums, counts, old.tolist())],
            np.int64,
        )
        places, moved = old.astype(np.float64), new.astype(np.float64)
        drift = np.sqrt(((moved - places) ** 2).sum(1))
        model = Model(new, drift, loosening(places, radii, places, moved))

    last = keeper.advance(_last_round(model), _RESULT, bounds if rounds else (), (id_column,))
    if watch is not None:
        watch.append(last.agg(F.sum("n_scanned")).first()[0])
    inertia = {row["cluster"]: row["inertia"] for row in _totals(last, dim)}
    summary = [
        (i, inertia.get(i, 0), sum(inertia.values()), centroid_hash(center))
        for i, center in enumerate(model.centers.tolist())
    ]
    per_cluster = spark.createDataFrame(
        summary, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    listed = F.inline(
        F.arrays_zip(F.col(id_column), F.col("clusters").alias("cluster"), F.col("distances").alias("distance"))
    )
    # One row per cluster: small by the number of clusters.
    return last.select(listed).join(F.broadcast(per_cluster), "cluster").select(
        id_column, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def centroid_hash(center: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, center)).encode()).hexdigest()
