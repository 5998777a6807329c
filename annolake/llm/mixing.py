"""Entropy balancing: document rates that meet token targets per source.

Rates ``r`` minimise the relative entropy to "take everything once" under two constraints: the
tokens a source gives equal its target, and no document is taken more than ``cap`` times.  The
solution is an exponential tilt ``r = min(cap, exp(lambda_source * size / mean size))``, and
``lambda`` minimises the convex dual.  Newton steps on the dual are Spark aggregates over the
(source, size) histogram, guarded by a bracket that halves whenever a step would leave it.  All sums
run in whole numbers, so no order of rows changes a bit of the result.

Rates become copies by systematic rounding: rows of a source stand in size order and a row gets
the whole numbers its stretch of the running sum of rates passes.  Equal rows are one stretch and share what it
passes as evenly as whole numbers go.  The error of a source stays below one document; rates at or under ``cap``
never round above it.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolake.llm.common import free_name, join_keys, row_hash, stage, table, text_key, word_count
from annolake.operators.ordered import with_running_totals

CAP = 3
MAX_STEPS = 80
TOLERANCE = 1e-7
_RATE_UNIT = 2**40  # steps of a rate inside the dual
_COPY_UNIT = 2**24  # steps of a rate in the running sum
#: Equal rows that one input row of the last step becomes.
_CHUNK = 1000


def source_targets(sizes: DataFrame, cap: int = CAP, cycle: int = 3) -> DataFrame:
    """Targets per source from ``(source, source_size)``: weights 1, 2, 3, repeating, in code-point
    order (null last) share the sum of all sizes; none gets more than ``cap`` times its own size,
    and what it cannot take is shared again by weight.

    That is water filling: with sources in order of ``cap * size / weight`` a prefix is full and
    the rest lies at one level.  One row per source is all that is ever sorted here.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % cycle + 1).cast("double"))
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    room = F.col("source_size") * F.lit(cap)
    levels = weighted.select(
        "*",
        room.alias("_room"),
        F.sum("source_size").over(every).alias("_total"),
        (
            (F.sum("source_size").over(every) - F.coalesce(F.sum(room).over(before), F.lit(0)))
            / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        ).alias("_level"),
    ).withColumn("_full", F.col("_level") * F.col("weight") > F.col("_room"))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(every)
    open_tokens = F.col("_total") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_room"))).over(every), F.lit(0))
    return levels.select(
        "source",
        "source_size",
        F.when(F.col("_full"), F.col("_room").cast("double"))
        .otherwise(F.col("weight") * open_tokens / open_weight)
        .alias("target"),
    )


def _rate(lam: Column, mean: Column, cap: int) -> Column:
    """Quantised rate; a null ``lam`` marks a source whose documents are all taken ``cap`` times."""
    tilt = F.least(F.lit(float(cap)), F.exp(lam * F.col("size") / mean))
    return F.round(F.coalesce(tilt, F.lit(float(cap))) * F.lit(float(_RATE_UNIT))).cast("decimal(14,0)")


def solve_dual(histogram: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """``(source, mean, lam)`` from ``(source, size, n)`` and ``(source, source_size, target)``."""
    rows = histogram.groupBy("source").agg(F.sum("n").alias("_rows"))
    known = join_keys(targets, rows, ["source"], "inner")
    mean = F.greatest(F.col("source_size") / F.col("_rows"), F.lit(1e-9))
    least = 1.0 / mean
    tiny = F.lit(1e-300)
    below = F.log(F.greatest(F.col("target"), tiny) / F.greatest(F.col("source_size"), tiny)) / least
    state = stage(
        known.select(
            "source",
            "target",
            mean.alias("mean"),
            F.when(F.col("target") < F.col("source_size"), below).otherwise(F.lit(0.0)).alias("lo"),
            F.when(F.col("target") < F.col("source_size"), F.lit(0.0))
            .otherwise(F.lit(math.log(cap)) / least)
            .alias("hi"),
            F.when(F.col("target") >= F.col("source_size") * cap, F.lit(None).cast("double"))
            .otherwise(F.lit(0.0))
            .alias("lam"),
        ),
        "dual",
    )
    for _ in range(MAX_STEPS):
        joined = join_keys(histogram, state, ["source"], "inner")
        quant = _rate(F.col("lam"), F.col("mean"), cap)
        tokens = (F.col("size") * F.col("n")).cast("decimal(18,0)")
        slope = F.when(
            quant < F.lit(cap * _RATE_UNIT), (F.col("size").cast("decimal(20,0)") * tokens).cast("decimal(22,0)") * quant
        ).otherwise(F.lit(0))
        sums = joined.groupBy("source", "target", "mean", "lo", "hi", "lam").agg(
            (F.sum(tokens * quant).cast("double") / F.lit(float(_RATE_UNIT))).alias("f"),
            (F.sum(slope).cast("double") / F.lit(float(_RATE_UNIT)) / F.col("mean")).alias("g"),
        )
        gap = F.col("f") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        done = F.col("lam").isNull() | (F.abs(gap) <= F.col("target") * TOLERANCE)
        stepped = (
            sums.select("*", lo.alias("_lo"), hi.alias("_hi"), done.alias("done"))
            .withColumn("_step", F.when(F.col("g") > 0, F.col("lam") - gap / F.col("g")))
            .select(
                "source",
                "target",
                "mean",
                F.col("_lo").alias("lo"),
                F.col("_hi").alias("hi"),
                F.when(F.col("done"), F.col("lam"))
                .when((F.col("_step") > F.col("_lo")) & (F.col("_step") < F.col("_hi")), F.col("_step"))
                .otherwise((F.col("_lo") + F.col("_hi")) / 2)
                .alias("lam"),
                "done",
            )
        )
        state = stage(stepped, "dual")
        if state.filter(~F.col("done")).isEmpty():
            break
        state = state.drop("done")
    else:
        warnings.warn(f"some sources missed their target by more than {TOLERANCE:g} of it after {MAX_STEPS} steps", stacklevel=2)
    return state.select("source", "mean", "lam")


def _totals(rows: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """``keys, source, size, n, source_size, target, rate, total``: ``n`` equal rows are taken ``total`` times together."""
    distinct = stage(rows.groupBy(*keys, "source", "size").agg(F.count("*").alias("n")), "mix")
    histogram = stage(distinct.groupBy("source", "size").agg(F.sum("n").alias("n")), "mix-sizes")
    sizes = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stage(source_targets(sizes, cap), "mix-targets")
    dual = solve_dual(histogram, targets, cap)
    solved = join_keys(targets, dual, ["source"], "inner")
    rated = join_keys(distinct, solved, ["source"], "inner").select(
        *keys,
        "source",
        "size",
        "n",
        "source_size",
        "target",
        (_rate(F.col("lam"), F.col("mean"), cap).cast("double") / F.lit(float(_RATE_UNIT))).alias("rate"),
    )
    step = F.round(F.col("rate") * F.lit(float(_COPY_UNIT))).cast("long") * F.col("n")
    order = [F.col("size").desc(), F.xxhash64(*[F.col(k) for k in keys]), *keys]
    summed = with_running_totals(rated.withColumn("_part", step), ["source"], order, {"_upto": F.col("_part")})
    half = F.lit(_COPY_UNIT // 2)
    passed = lambda upto: F.floor((upto + half) / F.lit(_COPY_UNIT))
    total = passed(F.col("_upto")) - passed(F.col("_upto") - F.col("_part"))
    return summed.withColumn("total", total).drop("_upto", "_part")


def balanced_copies(rows: DataFrame, keys: list[str], cap: int = CAP) -> DataFrame:
    """``keys``, ``source``, ``size``, ``source_size``, ``target``, ``rate`` and ``copies`` (0 to ``cap``) of ``rows``, of
    which ``rows`` equal ones get these copies each.

    Repeated rows count towards all sums; where their copies are no multiple of their number, some get one more
    than the others and they take two rows here.  A null source is a source of its own; rows of size 0 give no
    tokens and are taken about once.  An empty table gives an empty one.  A source may hold any share of the
    rows: sums combine before the shuffle, and running sums go by range chunks.
    """
    totals = _totals(rows, keys, cap)
    each, more = F.expr("total div n"), F.expr("total % n")
    groups = F.array(
        F.struct(more.alias("rows"), (each + 1).cast("int").alias("copies")),
        F.struct((F.col("n") - more).alias("rows"), each.cast("int").alias("copies")),
    )
    return totals.select(*totals.columns, F.inline(groups)).filter("rows > 0").drop("n", "total")


def _multiplied(df: DataFrame, times: str, keys: list[str]) -> DataFrame:
    """Every row as often as its column ``times`` says, which is dropped; many equal rows are made by several tasks."""
    chunk, nth = free_name("_chunk", df), free_name("_nth", df)
    chunked = df.withColumn(chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / _CHUNK))))
    left = F.least(F.lit(_CHUNK), F.col(times) - F.col(chunk) * _CHUNK)
    dealt = chunked.repartition(*keys, chunk)
    return dealt.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), left))).drop(chunk, nth, times)


def mix_documents(docs: DataFrame, cap: int = CAP) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it; columns stay as they are.

    Equal rows are taken together as often as their tokens need.
    """
    row, copy, total = (free_name(name, docs) for name in ("_row", "_copy", "_total"))
    marked = docs.withColumn(row, row_hash(docs))
    rows = marked.select(F.col("doc_id").alias("_id"), F.col(row).alias("_row"), "source", word_count().alias("size"))
    taken = stage(_totals(rows, ["_id", "_row"], cap).filter("total > 0").select("_id", "_row", "n", "total"), "mix-copies")

    def of(some: DataFrame) -> DataFrame:
        joined = marked.join(some, (marked[row] == some["_row"]) & marked["doc_id"].eqNullSafe(some["_id"]))
        return joined.select(*[marked[c] for c in marked.columns], some["total"].alias(total))

    single, repeated = taken.filter("n = 1"), taken.filter("n > 1")
    mixed = of(single).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(total)))).drop(copy, total)
    if not repeated.isEmpty():
        mixed = mixed.union(_multiplied(of(repeated).dropDuplicates(["doc_id", row]), total, [row]))
    return mixed.drop(row)


def op10_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", text_key().alias("_text"), "source", word_count().alias("size"))
    copies = balanced_copies(rows, ["doc_id", "_text"])
    return _multiplied(copies, "rows", ["doc_id", "_text"]).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "rate",
        "copies",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op10_entropy_balancing": op10_entropy_balancing}
ORACLES: dict[str, str] = {}
