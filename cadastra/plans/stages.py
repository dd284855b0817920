"""Ordered stages with a run log: optional ones may fail, essential ones stop the run, a run can be resumed."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

SCHEMA = "run string, stage string, status string, seconds double, error string, at timestamp"


@dataclass(frozen=True)
class Stage:
    name: str
    work: Callable[[SparkSession], object]
    optional: bool = False


class RunLog:
    """Append-only table of stage outcomes; each is written at once, so it survives the failure of the run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, run: str, stage: str, status: str, seconds: float, error: str | None) -> None:
        from datetime import datetime

        self.spark.createDataFrame([(run, stage, status, seconds, error, datetime.now())], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def done(self, run: str) -> set[str]:
        try:
            rows = self.spark.read.schema(SCHEMA).parquet(self.path)
            return {r.stage for r in rows.where((rows.run == run) & (rows.status == "ok")).select("stage").collect()}
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return set()
            raise


def run_stages(spark: SparkSession, stages: Sequence[Stage], log: RunLog, skip: Sequence[str] = (), resume: str | None = None) -> tuple[str, bool]:
    """Runs the stages in order; the run id, and whether all essential ones went well. skip: names left out; resume: a run whose good
    stages are not run again."""
    run = resume or uuid.uuid4().hex[:12]
    done = log.done(run) if resume else set()
    for s in stages:
        if s.name in skip or s.name in done:
            continue
        began = time.time()
        try:
            s.work(spark)
        except Exception as e:
            log.add(run, s.name, "failed", time.time() - began, str(e)[:500])
            if not s.optional:
                return run, False
        else:
            log.add(run, s.name, "ok", time.time() - began, None)
    return run, True


def preflight(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, str, str]]:
    """(item, ok | aviso | falha, detail) of what a run needs: version, adaptive execution, time zone, shared folder, inputs."""
    conf = spark.conf
    rows = [("spark", "ok" if spark.version >= "4" else "falha", spark.version)]
    rows.append(("adaptive", "ok" if conf.get("spark.sql.adaptive.enabled") == "true" else "aviso", conf.get("spark.sql.adaptive.enabled")))
    rows.append(("time zone", "ok" if conf.get("spark.sql.session.timeZone") == "UTC" else "aviso", conf.get("spark.sql.session.timeZone")))
    shared = conf.get("spark.checkpoint.dir", None)
    rows.append(("checkpoint folder", "ok" if shared else "aviso", shared or "unset"))
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        rows.append((p, "ok" if there else "falha", "there" if there else "missing"))
    return rows
