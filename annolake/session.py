"""Session defaults and the few helpers every operator shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only after it was counted and found at or below this.
BROADCAST_MAX_ROWS = 100_000


def build_session(app: str = "annolake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset (tests,
    local runs) a fresh temporary folder is made.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="annolake-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), "staging", f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: survives lost executors, stays prunable."""
    path = staging_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folders(spark: SparkSession, folders: set[str]) -> None:
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def release(staged: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more, so that loops do not fill the shared folder."""
    delete_folders(staged.sparkSession, {name.rsplit("/", 1)[0] for name in staged.inputFiles()})


def forget_shuffles(spark: SparkSession) -> None:
    """Spark deletes the files of a shuffle when the driver has forgotten it, which may otherwise be long after its job."""
    spark._jvm.System.gc()


#: What Parquet cannot hold, as it stands in a schema's text.
_UNSTORED = ("void", "interval", "variant", "struct<>")


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as they are now, from the shared folder: survives lost executors, and what made them need not stay on disk.

    Staged as compressed columns, a fraction of a checkpoint's size; only what Parquet cannot hold is checkpointed.
    """
    shared_dir(df.sparkSession)
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names) or any(kind in df.schema.simpleString() for kind in _UNSTORED):
        cut = df.checkpoint(eager=True)
    else:
        cut = stage(df, "cut")
    forget_shuffles(df.sparkSession)
    return cut


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast when the side really is small; else leave the join to the optimizer."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
