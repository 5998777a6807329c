"""What the operators of this subpackage share: staging, keys, words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.session import delete_folders, forget_shuffles, release, staging_path  # noqa: F401  (release for the others)

#: White space that parts words everywhere in this subpackage: blank and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"


#: Folders that tables were staged in, for each call of ``settled`` that is under way.
_ASIDE: list[list[str]] = []


def stage(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cut lineage that survives lost executors."""
    path = staging_path(df.sparkSession, name)
    if _ASIDE:
        _ASIDE[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.parquet(path)


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The staged table that ``build`` makes; what was staged to make it is deleted, and its shuffles may go."""
    _ASIDE.append([])
    try:
        made = build()
        path = staging_path(spark, name)
        made.write.option("compression", "zstd").parquet(path)
    finally:
        folders = _ASIDE.pop()
        delete_folders(spark, set(folders))
    if _ASIDE:
        _ASIDE[-1].append(path)
    del made
    forget_shuffles(spark)
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_key(name: str = "text") -> Column:
    """Tells rows of one id with different texts apart; null and empty text are alike."""
    return F.xxhash64(text_or_empty(name))


def word_count(name: str = "text") -> Column:
    return F.regexp_count(text_or_empty(name), F.lit(WORD)).cast("long")


def join_keys(left: DataFrame, right: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    """Join on null-safe keys, keeping the left key columns only."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in names else c) for c in right.columns])
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(renamed[f"_r_{name}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{name}" for name in names])


def row_hash(df: DataFrame) -> Column:
    """Tells rows apart by all their columns; repeated rows are alike."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no column of ``frames`` is called so."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
