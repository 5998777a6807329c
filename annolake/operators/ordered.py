"""Running totals, ranks and look-back windows that never put a whole key into one task.

A plain ``Window.partitionBy(key)`` sorts one key in one task, which breaks when a key
holds a third of the table.  Here the rows are range-partitioned on (key, order), so a big
key spreads over many chunks; each chunk is totalled first and only the totals of a key's
earlier chunks are added back.  The chunk layout is checkpointed, so a re-run task cannot
see different range bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolake.session import broadcast_checked, cut_lineage

# Rows of one key handled together when a window looks back a few rows.
HALO_CHUNK_ROWS = 50_000


def _sort_column(item: str | Column) -> Column:
    return F.col(item) if isinstance(item, str) else item


def with_running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    weights: dict[str, Column],
    num_chunks: int | None = None,
) -> DataFrame:
    """Add, per name in ``weights``, the running total of that weight within ``keys``.

    ``order`` must make the order within a key total.
    """
    keys = list(keys)
    order_columns = [_sort_column(item) for item in order]
    chunks = num_chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weighted = df.select("*", *[value.alias(f"_w_{name}") for name, value in weights.items()])
    staged = cut_lineage(
        weighted.repartitionByRange(chunks, *[F.col(k) for k in keys], *order_columns).withColumn(
            "_chunk", F.spark_partition_id()
        )
    )

    totals = staged.groupBy(*keys, "_chunk").agg(
        *[F.sum(f"_w_{name}").alias(f"_t_{name}") for name in weights]
    )
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # Chunks are contiguous, so a chunk continues at most one key: at most `chunks` rows here.
    carried = (
        totals.select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            F.col("_chunk").alias("_k_chunk"),
            *[F.sum(f"_t_{name}").over(earlier).alias(f"_c_{name}") for name in weights],
            F.row_number().over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_nth"),
        )
        .filter("_nth > 1")
        .drop("_nth")
    )
    matches = F.col("_chunk") == F.col("_k_chunk")
    for key in keys:
        matches = matches & F.col(key).eqNullSafe(F.col(f"_k_{key}"))

    within = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(*order_columns)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        staged.join(F.broadcast(carried), matches, "left")
        .select(
            *df.columns,
            *[
                (F.sum(f"_w_{name}").over(within) + F.coalesce(F.col(f"_c_{name}"), F.lit(0))).alias(name)
                for name in weights
            ],
        )
    )


def with_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str = "rank",
    num_chunks: int | None = None,
) -> DataFrame:
    """Add an exact 1-based row number within ``keys`` (``keys`` may be empty)."""
    return with_running_totals(df, keys, order, {name: F.lit(1).cast("long")}, num_chunks)


def with_usual_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank", most: int = HALO_CHUNK_ROWS) -> DataFrame:
    """``with_rank`` of staged rows, most of whose keys have few: a key of up to ``most`` rows is ranked in a plain window,
    without the sampling, the checkpoint and the second sort that longer ones need."""
    keys = list(keys)
    long = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(*[F.col(k).alias(f"_l_{k}") for k in keys])
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long").alias(name)
    if long.isEmpty():
        return df.select("*", plain)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_l_{k}")) for k in keys])
    usual = df.join(long, same, "left_anti").select("*", plain)
    return usual.unionByName(with_rank(df.join(long, same, "left_semi"), keys, order, name))


def with_totals_by_position(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    weights: dict[str, Column],
    chunk_rows: int = HALO_CHUNK_ROWS,
) -> DataFrame:
    """Running totals where each row already knows its exact ``position``.

    Chunks then follow from the position alone: no sampling, no checkpoint.  Totals of
    earlier chunks come from one small aggregate, which is joined on the keys the window
    needs anyway.
    """
    keys = list(keys)
    staged = df.select(
        "*",
        F.floor(F.col(position) / chunk_rows).alias("_chunk"),
        *[value.alias(f"_w_{name}") for name, value in weights.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        staged.groupBy(*keys, "_chunk")
        .agg(*[F.sum(f"_w_{name}").alias(f"_t_{name}") for name in weights])
        .select(
            *keys,
            "_chunk",
            *[F.coalesce(F.sum(f"_t_{name}").over(earlier), F.lit(0)).alias(f"_c_{name}") for name in weights],
        )
    )
    within = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return staged.join(carried, [*keys, "_chunk"]).select(
        *df.columns,
        *[(F.sum(f"_w_{name}").over(within) + F.col(f"_c_{name}")).alias(name) for name in weights],
    )


def with_lookback(
    df: DataFrame,
    keys: Sequence[str],
    rank: str,
    lookback: int,
    columns: dict[str, "callable"],
    chunk_rows: int = HALO_CHUNK_ROWS,
) -> DataFrame:
    """Window expressions that read at most ``lookback`` earlier rows of the same key.

    Rows already carry an exact ``rank``.  A key is cut into runs of ``chunk_rows`` ranks;
    the last ``lookback`` rows of a run are repeated at the head of the next one, so every
    row still sees its whole look-back although no task holds a whole key.  ``columns``
    maps a new name to a function from window to Column; later ones may use earlier ones.
    """
    position = F.col(rank) - 1
    home = F.floor(position / chunk_rows)
    near_end = position % chunk_rows >= chunk_rows - lookback
    spread = df.withColumn("_home", home).withColumn(
        "_run",
        F.explode(F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))),
    )
    window = Window.partitionBy(*keys, "_run").orderBy(rank)
    computed = spread
    for name, make in columns.items():
        computed = computed.withColumn(name, make(window))
    return computed.filter("_run = _home").drop("_run", "_home")


def value_distribution(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key: count, min, max, mean and exact median of ``value``.

    Equal values are counted first and the counts ranked in value order, so neither a key
    nor its list of values has to fit into one task, and the input is read once.
    """
    keys = list(keys)
    counted = cut_lineage(df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n")))
    running = with_running_totals(counted, keys, [value], {"_upto": F.col("_n")})
    total = counted.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    if keys:
        # One row per key; few keys must not bring all their values into as few tasks.
        joined = running.join(broadcast_checked(total), keys)
    else:
        joined = running.withColumn("_total", total.select("_total").scalar())
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1
    covers = lambda rank: (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)
    return joined.groupBy(*keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("count"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
        (F.sum(F.col(value) * F.col("_n")) / F.sum("_n")).alias("mean"),
        (
            (F.max(F.when(covers(low), F.col(value))) + F.max(F.when(covers(high), F.col(value)))) / 2.0
        ).alias("median"),
    )
