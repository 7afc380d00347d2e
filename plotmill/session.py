"""Session builder and the few run-time helpers every plan shares."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that may be broadcast after they were counted; beyond it the plan shuffles instead.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def get_spark(app: str = "plotmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**base, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_code(spark)
    return spark


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the workers: executors of a cluster get an archive of it, local workers only if they do not start where it is on the path."""
    here = Path(__file__).resolve().parent
    context = spark.sparkContext
    local = context.master == "local" or context.master.startswith("local[")
    on_path = str(here.parent) in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep))
    if (local and on_path) or getattr(context, "_plotmill_shipped", False):
        return
    shared = urlparse(context.getConf().get("spark.checkpoint.dir", "") or "")
    # the driver serves the archive to the executors itself, so it may lie where only the driver reads
    folder = Path(shared.path) if shared.path and shared.scheme in ("", "file") else Path(tempfile.gettempdir())
    folder = folder / ("plotmill-" + uuid.uuid4().hex)
    folder.mkdir(parents=True)
    with zipfile.ZipFile(folder / "plotmill.zip", "w") as z:
        for f in here.rglob("*.py"):
            z.write(f, f.relative_to(here.parent))
    context.addPyFile(str(folder / "plotmill.zip"))
    context._plotmill_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, below: int = 16 << 20) -> DataFrame:
    """`df` over all cores if it is small (by the optimiser's estimate), for work that costs far more than a shuffle; larger inputs have partitions enough."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size < below else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df`, computed once and written to reliable storage that outlives any executor.

    The folder is taken from `spark.checkpoint.dir`. Only where that is unset (single-machine tests) a temporary folder is
    used; a cluster has to name a shared one.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        where = context.getConf().get("spark.checkpoint.dir", None)
        if not where:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            where = os.path.join(tempfile.gettempdir(), "plotmill-" + uuid.uuid4().hex)
        context.setCheckpointDir(where)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`df` with a broadcast hint if it has at most `limit` rows and about `most_bytes` (both are measured, up to the limit), else unchanged."""
    width = F.coalesce(F.length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))), F.lit(0))
    got = df.limit(limit + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if got["n"] <= limit and got["b"] <= most_bytes else df
