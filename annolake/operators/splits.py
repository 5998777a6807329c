"""Deterministic splits and samples, leakage checks, identity digests, subset selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolake.constants import SEED, SPLITS, TEST_RATIO, TRAIN_RATIO, VAL_RATIO
from annolake.functions import names
from annolake.operators.ordered import with_rank
from annolake.session import broadcast_checked, cut_lineage

# Keys hashed together at the leaves of an identity digest; a list no longer than this
# is hashed in one go.
DIGEST_CHUNK = 100_000
# Best candidates looked at together by the diverse sample.
DIVERSE_BATCH = 256


def seeded_hash(key: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))


def with_hash_rank(rows: DataFrame, key: str, seed: int = SEED, prefix: int = 4, name: str = "rank") -> DataFrame:
    """Exact global rank in hash order without a one-partition sort.

    Rows fall into 16**prefix hash buckets of equal expected size; only the bucket counts
    are summed globally, the row number is taken inside a bucket.
    """
    hashed = rows.withColumn("_hash", seeded_hash(F.col(key), seed)).withColumn(
        "_bucket", F.left("_hash", F.lit(prefix))
    )
    counts = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    # At most 16**prefix offset rows.
    return (
        hashed.join(F.broadcast(offsets), "_bucket")
        .withColumn(name, inside + F.col("_before"))
        .drop("_hash", "_bucket", "_before")
    )


def _check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1.0) > 1e-9:
        raise ValueError(f"Split ratios must sum to 1.0, got {train + val + test}")


def dedupe_records(rows: DataFrame, keys: Sequence[str] = ("source_split", "image_id")) -> DataFrame:
    """Keys that would make a split ambiguous."""
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def seeded_split(
    rows: DataFrame,
    key: str = "internal_record_id",
    train_ratio: float = TRAIN_RATIO,
    val_ratio: float = VAL_RATIO,
    test_ratio: float = TEST_RATIO,
    seed: int = SEED,
    check_unique: bool = True,
) -> DataFrame:
    """Add ``split`` with exactly int(n*train) and int(n*val) rows, the rest test; a repeated key is an error."""
    _check_ratios(train_ratio, val_ratio, test_ratio)
    if check_unique and not dedupe_records(rows, [key]).isEmpty():
        raise ValueError("Duplicate records detected before splitting.")
    total = rows.agg(F.count("*").alias("n")).select(F.col("n").cast("double")).scalar()
    train_rows = F.floor(total * F.lit(train_ratio))
    val_rows = F.floor(total * F.lit(val_ratio))
    split = (
        F.when(F.col("_rank") <= train_rows, "train")
        .when(F.col("_rank") <= train_rows + val_rows, "val")
        .otherwise("test")
    )
    return with_hash_rank(rows, key, seed, name="_rank").withColumn("split", split).drop("_rank")


def seeded_split_threshold(
    rows: DataFrame,
    key: str = "internal_record_id",
    train_ratio: float = TRAIN_RATIO,
    val_ratio: float = VAL_RATIO,
    seed: int = SEED,
) -> DataFrame:
    """Same ratios in expectation, decided per row: no shuffle, safe for streams."""
    share = F.conv(F.left(seeded_hash(F.col(key), seed), F.lit(8)), 16, 10).cast("long") / float(16**8)
    return rows.withColumn(
        "split",
        F.when(share < train_ratio, "train").when(share < train_ratio + val_ratio, "val").otherwise("test"),
    )


def seeded_sample(rows: DataFrame, key: str, k: int, seed: int = SEED) -> DataFrame:
    """Exactly ``k`` rows, the first in hash order (a distributed top-k)."""
    have = rows.limit(k).count()
    if have < k:
        raise ValueError(f"Cannot sample {k} rows from only {have}.")
    return rows.orderBy(seeded_hash(F.col(key), seed), key).limit(k)


def diverse_sample(
    rows: DataFrame,
    k: int,
    key: str = "internal_record_id",
    names_column: str = "category_names",
    count_column: str = "valid_object_count",
    seed: int = SEED,
) -> DataFrame:
    """``k`` records, each time the one that adds most unseen categories.

    Ties go to more categories, then more objects, then hash order.  Within one set of
    categories only the first ``k`` by (objects, hash) can ever be taken, so the table is
    first reduced to those; the ``k`` rounds then run on the reduced, checkpointed table.
    """
    annotated = rows.filter(F.col(count_column) > 0)
    pool = annotated
    if annotated.limit(k).count() < k:
        pool = rows
        if rows.limit(k).count() < k:
            raise ValueError(f"Need {k} usable records, found fewer.")
    signature = F.sort_array(F.array_distinct(names_column))
    best_first = Window.partitionBy("_set").orderBy(F.desc(count_column), "_hash", key)
    reduced = cut_lineage(
        pool.withColumn("_set", signature)
        .withColumn("_hash", seeded_hash(F.col(key), seed))
        .withColumn("_nth", F.row_number().over(best_first))
        .filter(F.col("_nth") <= k)
        .drop("_nth")
    )
    texts = lambda items: F.lit(list(items)).cast("array<string>")
    order: dict[str, int] = {}
    seen: set[str] = set()

    def place(row) -> tuple:
        return (-len(set(row["_set"]) - seen), -len(row["_set"]), -row[count_column], row["_hash"], row[key])

    while len(order) < k:
        unseen = F.size(F.array_except("_set", texts(sorted(seen))))
        batch = (
            reduced.filter(~F.array_contains(texts(order), F.col(key)))
            .orderBy(F.desc(unseen), F.desc(F.size("_set")), F.desc(count_column), "_hash", key)
            .select(key, "_set", count_column, "_hash")
            .limit(DIVERSE_BATCH)
            .collect()
        )
        # What a record adds can only shrink, so no record outside the batch ever comes
        # before the batch's last one: picks that still do are the exact next ones.
        bound = place(batch[-1]) if len(batch) == DIVERSE_BATCH else None
        while batch and len(order) < k:
            best = min(batch, key=place)
            if bound is not None and place(best) > bound:
                break
            batch.remove(best)
            order[best[key]] = len(order) + 1
            seen.update(best["_set"])
    return (
        reduced.filter(F.col(key).isin(*order))
        .withColumn("pick", F.array_position(texts(order), F.col(key)).cast("int"))
        .drop("_set", "_hash")
    )


def candidate_scan_first(files: DataFrame, roots: DataFrame, extensions: Sequence[str], n: int) -> DataFrame:
    """First ``n`` files by (root order, path), one per resolved path."""
    kept = files.join(broadcast_checked(roots), "root").filter(
        names.extension(F.col("path")).isin(*extensions)
    )
    first = kept.groupBy("resolved").agg(F.min(F.struct("root_rank", "path")).alias("_first"))
    return (
        first.select("_first.root_rank", "_first.path", "resolved")
        .orderBy("root_rank", "path")
        .limit(n)
    )


def split_bit(split: Column) -> Column:
    """1, 2, 4 for train, val, test; 0 for anything else."""
    value = F.lit(0)
    for i, name in enumerate(SPLITS):
        value = F.when(split == name, F.lit(1 << i)).otherwise(value)
    return value


def split_leakage(rows: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Keys shared by two splits, per kind of key; one shuffle for all kinds and pairs."""
    long = rows.select(
        "split",
        F.explode(
            F.array(*[F.struct(F.lit(kind).alias("kind"), value.alias("key")) for kind, value in keys.items()])
        ).alias("_item"),
    ).select("split", "_item.kind", "_item.key")
    # A bit per split keeps the aggregate a plain hash aggregate with map-side combine.
    bit = {name: 1 << i for i, name in enumerate(SPLITS)}
    held = long.groupBy("kind", "key").agg(F.bit_or(split_bit(F.col("split"))).alias("_splits"))
    pairs = [("test", "train"), ("test", "val"), ("train", "val")]
    counted = held.groupBy("kind").agg(
        *[
            F.count_if(F.col("_splits").bitwiseAND(F.lit(bit[a] | bit[b])) == (bit[a] | bit[b])).alias(f"{a}_{b}")
            for a, b in pairs
        ]
    )
    counted = counted.select(
        "kind",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("left_split"), F.lit(b).alias("right_split"), F.col(f"{a}_{b}").alias("overlaps"))
                    for a, b in pairs
                ]
            )
        ),
    )
    every = rows.sparkSession.createDataFrame(
        [(kind, a, b) for kind in keys for a, b in pairs], "kind string, left_split string, right_split string"
    )
    return every.join(counted, ["kind", "left_split", "right_split"], "left").fillna(0, ["overlaps"])


def overlap_keys(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    return left.select(*columns).intersect(right.select(*columns))


def identity_digest(rows: DataFrame, group: str, key: str, chunk: int = DIGEST_CHUNK) -> DataFrame:
    """SHA-256 tree over the sorted keys of each group, one line per key.

    Runs of ``chunk`` sorted keys are hashed, and the run digests are hashed the same way, at least
    once, until one is left: one rule for groups of any size, and no task ever holds more than
    ``chunk`` keys.
    """
    ranked = with_rank(rows.select(group, F.col(key).alias("_key")), [group], ["_key"], "_rank")
    level = ranked.select(group, (F.col("_rank") - 1).alias("_at"), F.col("_key").alias("_text"))
    count = rows.groupBy(group).agg(F.count("*").alias("count"))
    finished, leaves = None, True
    while True:
        level = cut_lineage(
            level.groupBy(group, F.floor(F.col("_at") / chunk).alias("_run"))
            .agg(F.sort_array(F.collect_list(F.struct("_at", "_text"))).alias("_items"))
            .select(
                group,
                F.col("_run").alias("_at"),
                F.sha2(F.concat(F.array_join(F.col("_items._text"), "\n"), F.lit("\n")), 256).alias("_text"),
            )
        )
        # A group is done once it is down to one digest of digests; the others go on.
        unfinished = (level if leaves else level.filter("_at > 0")).select(group).distinct()
        leaves = False
        done = level.join(unfinished, group, "left_anti")
        finished = done if finished is None else finished.unionByName(done)
        if unfinished.isEmpty():
            break
        level = level.join(unfinished, group, "left_semi")
    return finished.select(group, F.col("_text").alias("sha256")).join(count, group)


def order_free_digest(rows: DataFrame, group: str, key: str) -> DataFrame:
    """Digest that needs no order: row count and the sums of two 60-bit halves of each key's hash."""
    digits = F.md5(F.col(key).cast("binary"))
    halves = [F.sum(F.conv(F.substring(digits, at, 15), 16, 10).cast("decimal(28,0)")).cast("string") for at in (1, 16)]
    return rows.groupBy(group).agg(F.count("*").alias("count"), F.concat_ws(":", *halves).alias("digest"))


def subset_semi_join(annotations: DataFrame, selected: DataFrame) -> DataFrame:
    """Annotations of the selected images with the selection's order column ``ord``."""
    first = selected.groupBy("source_split", "image_id").agg(F.min("ord").alias("ord"))
    return annotations.join(first, ["source_split", "image_id"])
