"""Document fingerprints as invertible Bloom lookup tables over paragraph digests.

A document is the set of its paragraph digests: lines, long ones in pieces of ``PIECE`` characters.
Each digest falls into one cell of each of three subtables; a cell keeps a signed count, the
XOR of its digests and the XOR of their checks.  Subtracting the table of another version cancels
what both share.  A cell that holds one digest (count +-1, matching check) gives it away; taking it out of its
other cells opens more, until the table is empty and the differing digests are known.  A pair whose
table does not empty is tried again with tables of twice the size.

Cells are rows ``(document, pair, cell)``; only cells that are not empty exist.  Everything is keyed by the
document first and the staged digests are bucketed by it, so peeling runs without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.llm.common import stage, table
from annolake.llm.substring import LAST_ID, keyed_documents
from annolake.operators.ordered import with_rank

#: Characters of a paragraph at most.
PIECE = 96
#: Cells of a subtable beyond one for each digest of both versions.
SPARE = 16
#: Passes over the three subtables, one subtable each, before a pair is tried again.
PASSES = 8
TRIES = 12


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of the paragraphs of ``text``; none for an empty text."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{PIECE}}}\n*|\n+"), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda piece: F.xxhash64(piece)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def _cells(digest: Column, width: Column, salt: int) -> list[Column]:
    return [F.lit(j) * width + F.pmod(F.xxhash64(digest, F.lit(3 * salt + j)), width) for j in range(3)]


def fingerprint(digest_list: Column) -> Column:
    """The cell that holds the whole set, as text: count, XOR of digests, XOR of checks."""
    start = F.lit(0).cast("long")
    keys = F.aggregate(digest_list, start, lambda all_, d: all_.bitwiseXOR(d))
    checks = F.aggregate(digest_list, start, lambda all_, d: all_.bitwiseXOR(_check(d)))
    padded = [F.lpad(F.hex(c), 16, "0") for c in (keys, checks)]
    return F.lower(F.concat(F.hex(F.size(digest_list)), F.lit("-"), *padded))


def peel(sketches: DataFrame, salt: int, passes: int = PASSES) -> DataFrame:
    """``id, key, pair, kind, slot, count`` from ``id, key, pair, plus, minus, scale``.

    ``kind`` 1 is a differing digest (``slot``; ``count`` tells which side has it), kind 0 a cell that did not
    empty.  ``scale`` multiplies the table size.
    """
    width = ((F.size("plus") + F.size("minus") + SPARE) * F.col("scale")).cast("long")
    signed = lambda name, sign: F.transform(name, lambda d: F.struct(d.alias("digest"), F.lit(sign).alias("sign")))
    sides = [signed("plus", 1), signed("minus", -1)]
    items = sketches.select("id", "key", "pair", width.alias("width"), F.inline(F.concat(*sides)))
    spread = items.select(
        "id", "key", "pair", "width", "digest", F.col("sign").cast("long").alias("count"),
        F.explode(F.array(*_cells(F.col("digest"), F.col("width"), salt))).alias("slot"),
    )
    keys = ["id", "key", "pair", "width", "kind", "slot"]
    sums = [
        F.sum("count").alias("count"), F.bit_xor("digest").alias("digest"), F.bit_xor("check").alias("check")
    ]
    held = F.expr("kind = 1 OR count <> 0 OR digest <> 0 OR `check` <> 0")
    cells = (
        spread.withColumn("check", _check(F.col("digest"))).withColumn("kind", F.lit(0)).groupBy(*keys).agg(*sums).filter(held)
    )
    for step in range(passes):
        part = step % 3  # a digest has one cell in each subtable, so a pass finds it once
        own = (F.col("kind") == 0) & (F.floor(F.col("slot") / F.col("width")) == part)
        pure = own & (F.abs("count") == 1) & (F.col("check") == _check(F.col("digest")))
        row = lambda kind, slot, count, digest, check: F.struct(
            kind.alias("kind"), slot.alias("slot"), count.alias("count"), digest.alias("digest"), check.alias("check")
        )
        itself = row(F.col("kind"), F.col("slot"), F.col("count"), F.col("digest"), F.col("check"))
        others = [c for j, c in enumerate(_cells(F.col("digest"), F.col("width"), salt)) if j != part]
        out = [row(F.lit(0), c, -F.col("count"), F.col("digest"), F.col("check")) for c in others]
        found = row(F.lit(1), F.col("digest"), F.col("count"), F.lit(0).cast("long"), F.lit(0).cast("long"))
        cells = (
            cells.select("id", "key", "pair", "width", F.explode(F.when(pure, F.array(found, *out)).otherwise(F.array(itself))).alias("r"))
            .select("id", "key", "pair", "width", "r.*")
            .groupBy(*keys)
            .agg(*sums)
            .filter(held)
        )
    return cells.select("id", "key", "pair", "kind", "slot", "count")


def differences(sketches: DataFrame) -> DataFrame:
    """``id, key, pair, n_differ`` for every row of ``sketches`` (``id, key, pair, plus, minus``)."""
    todo, tried = sketches.withColumn("scale", F.lit(1)), []
    for attempt in range(TRIES):
        result = (
            peel(todo, attempt)
            .groupBy("id", "key", "pair")
            .agg(F.sum("kind").alias("n_differ"), F.max(F.expr("kind = 0")).alias("failed"))
        )
        tried.append(stage(result, "peeled"))
        failed = tried[-1].filter("failed").select("id", "key", "pair")
        if failed.isEmpty():
            break
        todo = sketches.join(failed, ["id", "key", "pair"], "left_semi").withColumn("scale", F.lit(2 << attempt))
    else:
        raise RuntimeError("some tables did not empty at any size")
    done = tried[0].filter("NOT failed")
    for more in tried[1:]:
        done = done.union(more.filter("NOT failed"))
    return done.select("id", "key", "pair", "n_differ")


def with_next(docs: DataFrame) -> DataFrame:
    """Documents (one row per id and text) beside the next in ascending order; the first follows the last.

    ``id, key, text, next_digests, next_head``, the latter the first ``floor(n_chars / 4)`` characters of
    the next text.
    """
    texts = keyed_documents(docs).dropDuplicates(["id", "key"])
    small = keyed_documents(docs).select("id", "key", F.length("text").alias("n")).distinct()
    ranked = stage(with_rank(small, [], ["id", "key"], "rank"), "order")
    last = ranked.count()
    before = ranked.select(
        F.col("id").alias("prev_id"), F.col("key").alias("prev_key"), F.floor(F.col("n") / 4).cast("int").alias("take"),
        (F.col("rank") % F.lit(max(last, 1)) + 1).alias("rank"),
    )
    links = ranked.join(before, "rank").select("id", "key", "prev_id", "prev_key", "take")
    heads = texts.join(links, ["id", "key"]).select(
        F.col("prev_id").alias("id"),
        F.col("prev_key").alias("key"),
        F.expr("substring(text, 1, take)").alias("next_head"),
        digests(F.col("text")).alias("next_digests"),
    )
    return texts.join(heads, ["id", "key"])


def compare_versions(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.

    The edited text is the text with its last quarter replaced by the head of the next document (ascending
    id, then text hash; after the last the first).  Likeness is one minus the differing digests over the
    digests of both; two texts without digests are alike (1).  A null text is empty.  A null id
    comes after all others.  Repeated rows count as one document in the order and get the same result
    each; rows of one id with different texts follow each other.  Other columns are not read; an
    empty table gives an empty one.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = F.length("text")
    cut = F.expr("concat(substring(text, 1, length(text) - floor(length(text) / 4)), next_head)")
    versions = (
        with_next(docs)
        .withColumn("edited", cut)
        .select(
            "id", "key", count.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
            digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("edited"), "next_digests",
        )
    )
    name = f"versions_{uuid.uuid4().hex}"
    versions.write.bucketBy(partitions, "id", "key").format("parquet").saveAsTable(name)
    kept = spark.table(name)
    pairs = kept.select(
        "id", "key",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("pair"), F.col("own").alias("plus"), F.col("edited").alias("minus")),
                F.struct(F.lit(1).alias("pair"), F.col("own").alias("plus"), F.col("next_digests").alias("minus")),
            )
        ),
    )
    differ = differences(pairs).groupBy("id", "key").agg(
        *[F.max(F.when(F.col("pair") == p, F.col("n_differ"))).alias(f"differ_{p}") for p in (0, 1)]
    )
    sizes = {0: F.size("own") + F.size("edited"), 1: F.size("own") + F.size("next_digests")}
    near = {p: F.when(sizes[p] == 0, 1.0).otherwise(1.0 - F.coalesce(F.col(f"differ_{p}"), F.lit(0)) / sizes[p]) for p in (0, 1)}
    result = stage(
        kept.join(differ, ["id", "key"], "left").select(
            "id", "key", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
            fingerprint(F.col("edited")).alias("edited_fingerprint"), near[0].alias("near_edited"), near[1].alias("near_next"),
        ),
        "fingerprints",
    )
    spark.sql(f"DROP TABLE {name}")
    rows = keyed_documents(docs).select("id", "key")
    doc_id = F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id")
    return rows.join(result, ["id", "key"]).select(doc_id, *result.columns[2:])


def op9_invertible_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_versions(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op9_invertible_lookup": op9_invertible_lookup}
ORACLES: dict[str, str] = {}
