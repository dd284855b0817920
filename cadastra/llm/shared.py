"""What several operators need: tables in the shared folder, checked broadcasts, connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel

#: A side is broadcast only if its counted rows times the given row width stay below this.
BROADCAST_BYTES = 32 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir. Where that is unset a temporary one, in local mode only: elsewhere
    executors would write to folders that the others can't see."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="cadastra-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Rows and bytes that go to a Python worker at once: with long texts the session's default of 10 000 rows may be gigabytes.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches, for workers with little memory; smaller bounds that are set stay."""
    for name, most in (("Records", BATCH_ROWS), ("Bytes", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.max{name}PerBatch"
        now = spark.conf.get(name).removesuffix("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(name, str(most))


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run(batches) for mapInArrow, whose memory goes back to the system at its end: a worker stays for later tasks of other kinds."""

    def wrapped(batches):
        yield from run(batches)
        kernel.powers.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # a C library without it
            pass

    return wrapped


class Scratch:
    """Intermediate tables of one run, written as Parquet to the shared folder. Reading them back cuts the lineage, survives the
    loss of executors and gives the planner real sizes."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0
        self.paths: list[str] = []

    def put(self, df: DataFrame, tag: str = "t") -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n:03d}-{tag}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self.paths.append(path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that no later plan reads."""
        for t in tables:
            self._delete(t._scratch_path)

    def keep(self, *tables: DataFrame) -> None:
        """Deletes all tables of this run but these, which the plan that is handed back still reads."""
        for path in set(self.paths) - {t._scratch_path for t in tables}:
            self._delete(path)

    def _delete(self, path: str) -> None:
        if path in self.paths:
            self.paths.remove(path)
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def checked_broadcast(small: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES, alias=lambda x: x) -> DataFrame:
    """Broadcast `small` (a written table, so counting reads footers only) if its size allows; else leave the join to shuffle.
    alias: a projection to apply."""
    return F.broadcast(alias(small)) if small.count() * row_bytes <= limit else alias(small)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of edges(u, v), of any one orderable type: node, root (smallest node), for every node with an edge.

    Alternating large-star and small-star steps. Every step is a grouped minimum (combined on the map side) and an equi-join,
    whose hot keys AQE splits; nothing is gathered on the driver but three counts a round. Null ends and loops are ignored.
    """

    def forest(e: DataFrame) -> bool:
        above = e.select(F.col("a").alias("b")).distinct()
        n, m = e.agg(F.count(F.lit(1)), F.count_distinct("a")).first()
        return n == m and e.join(above, "b", "left_semi").isEmpty()

    e = scratch.put(
        edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(),
        "edges",
    )
    while not forest(e):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = scratch.put(
            both.where("v > u or v < u").join(least, "u").where("v > u").select(F.col("v").alias("a"), F.least("u", "m").alias("b")).distinct(),
            "large",
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = scratch.put(
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("x"))
            .select("x.a", F.col("x.m").alias("b"))
            .where("a <> b")
            .distinct(),
            "small",
        )
        scratch.drop(e, large)
        e = small
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots.select("node", F.col("node").alias("root")))


#: Edges (of forests that tasks have left) that one last task may join, 32 MB; more go through the star steps.
ONE_TASK = 1 << 21


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over arrays: each node that isn't the smallest of its component, and that smallest one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:  # halve all paths until each node points to its root
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def stars(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Of a task's edges the stars (node, root) that join the same nodes; at no time more than a million edges and the nodes seen."""
    us, vs, n = [], [], 0
    for u, v in pairs:
        us.append(u)
        vs.append(v)
        n += len(u)
        if n > 1 << 20:
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            us, vs, n = [u], [v], 0
    if us:
        u, v = forest(np.concatenate(us), np.concatenate(vs))
        for k in range(0, len(u), 1 << 17):
            yield pa.record_batch([pa.array(u[k : k + (1 << 17)], pa.int64()), pa.array(v[k : k + (1 << 17)], pa.int64())], ["node", "root"])


def _forests(batches):
    return stars((b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches)


def united(edges: DataFrame, scratch: Scratch, one_task: int | None = None) -> DataFrame:
    """Distributed union-find over edges(u, v), or each task's stars(node, root), of longs without nulls: node, root (the smallest of its
    component) of every node that isn't a root. Each task joins its own edges and hands on a forest, so parallel edges and hubs never
    leave it. What is left is joined in one task if its counted edges are ONE_TASK (32 MB) at most, else by the star steps of
    `components`."""
    made = "root" in edges.columns
    left = scratch.put(edges if made else edges.where("u <> v").select("u", "v").mapInArrow(lean(_forests), "node long, root long"), "forests")
    if left.count() <= (ONE_TASK if one_task is None else one_task):
        return scratch.put(left.coalesce(1).mapInArrow(lean(_forests), "node long, root long"), "united")
    return scratch.put(components(left.select(F.col("node").alias("u"), F.col("root").alias("v")), scratch).where("node <> root"), "united")
