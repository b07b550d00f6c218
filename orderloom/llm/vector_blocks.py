"""Vectors packed into blocks, and state kept beside them from round to round.

A block is one row: the ids and the integer components of up to BLOCK_ROWS vectors. The vectors are
written once, in buckets of the block's number; each round writes its state in the same buckets.
Joining the two then needs no exchange, so a round reads files, computes, and writes a few bytes for
each vector; only sums per cluster are shuffled. All of it lies in the shared folder, so a lost
executor costs its own tasks. The state of the round before is dropped once the next is complete.

Components must stay below 2**27 once scaled, so that squared distances fit a long; larger ones raise.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.session import new_folder
from orderloom.sinks.folders import drop

BLOCK_ROWS = 4096
BLOCKS_PER_BUCKET = 64
# Spark's own limit; beyond it (some 26 billion vectors) buckets grow.
MOST_BUCKETS = 100_000
LARGEST = 1 << 27
# Up to here sums of products are exact in doubles, for vectors of up to 256 components.
EXACT_IN_DOUBLES = 1 << 21


def finite(vector: Column) -> Column:
    """Whether the vector is there and holds no NULL, NaN or infinity."""
    ok = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(ok, F.lit(False))


def to_integers(values: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(values.astype(np.float64) * scale)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise ValueError(f"a component times {scale} is {LARGEST} or more: distances would not fit")
    return scaled.astype(np.int32)


def buckets_for(df: DataFrame, rows: int) -> int:
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = -(-rows // (BLOCK_ROWS * BLOCKS_PER_BUCKET))
    return min(MOST_BUCKETS, max(cores, wanted))


def _bucketed(df: DataFrame, purpose: str, buckets: int) -> tuple[DataFrame, str]:
    spark, folder = df.sparkSession, new_folder(df.sparkSession, purpose)
    name = f"orderloom_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").bucketBy(buckets, "block")
    writer.option("path", folder).saveAsTable(name)
    written = spark.table(name)
    written.schema  # resolved: it outlives the name
    spark.sql(f"DROP TABLE {name}")
    return written, folder


def packed(rows: DataFrame, vector: str, scale: int, dim: int, buckets: int, *carry: str) -> DataFrame:
    """Blocks of the rows' vectors, all of length `dim`, and of the columns carried along."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(["block long", "data binary", *[f"`{c}` array<{kinds[c]}>" for c in carry]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                flat = part.column("_vector").flatten().to_numpy(zero_copy_only=False)
                columns = [pa.array([number]), pa.array([to_integers(flat, scale).tobytes()], pa.binary())]
                for name in carry:
                    values = part.column(name)
                    columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
                yield pa.RecordBatch.from_arrays(columns, ["block", "data", *carry])
                number += 1

    blocks = rows.select(F.col(vector).alias("_vector"), *carry).mapInArrow(pack, schema)
    return _bucketed(blocks.repartition(buckets, "block"), "vectors", buckets)[0]


class Rounds:
    """The state of the blocks, replaced round by round."""

    def __init__(self, blocks: DataFrame, buckets: int, dim: int):
        self.blocks, self.buckets, self.dim = blocks, buckets, dim
        self.state: DataFrame | None = None
        self._folder: str | None = None

    def advance(
        self,
        step: Callable[[np.ndarray, dict | None], dict],
        schema: str,
        state: tuple[str, ...] = (),
        carry: tuple[str, ...] = (),
    ) -> DataFrame:
        """Apply `step(vectors, state)` to every block and keep what it returns as the new state.

        `state` names the columns of the former state that the step reads, as bytes; `carry` the
        block's own columns that are passed on.
        """
        spark, dim = self.blocks.sparkSession, self.dim
        source = self.blocks.select("block", "data", *carry)
        if self.state is not None:
            former = self.state.select("block", *state)
            source = source.join(former.hint("shuffle_hash"), "block")
        known = self.state is not None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    own = batch.slice(row, 1)
                    data = np.frombuffer(own.column("data")[0].as_py(), np.int32).reshape(-1, dim)
                    before = {c: own.column(c)[0].as_py() for c in state} if known else None
                    after = step(data, before)
                    columns = {"block": own.column("block")} | {c: own.column(c) for c in carry}
                    columns |= {c: pa.array([v]) if not isinstance(v, pa.Array) else v for c, v in after.items()}
                    yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        kinds = {f.name: f.dataType.simpleString() for f in self.blocks.schema.fields}
        full = ", ".join(["block long", *[f"`{c}` {kinds[c]}" for c in carry], schema])
        old = self._folder
        self.state, self._folder = _bucketed(source.mapInArrow(run, full), "rounds", self.buckets)
        if old is not None:
            drop(spark, old)
        return self.state


def listed(values: np.ndarray) -> pa.Array:
    """One list value that holds an array."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def squared_to(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distances of all vectors to all centers, as int64."""
    largest = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centers).max(initial=0)))
    if largest <= EXACT_IN_DOUBLES and vectors.shape[1] <= 256:
        x, c = vectors.astype(np.float64), centers.astype(np.float64)
        both = x @ c.T
        both *= -2
        both += (x * x).sum(1)[:, None]
        both += (c * c).sum(1)[None, :]
        return both.astype(np.int64)
    wide = vectors.astype(np.int64)
    return np.stack([((wide - c) ** 2).sum(1) for c in centers.astype(np.int64)], axis=1)


def squared_own(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distance of each vector to the center in the same row."""
    apart = vectors.astype(np.int64) - centers
    return (apart * apart).sum(-1)
