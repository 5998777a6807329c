"""Ordered helpers against plain windows, with one key that holds most rows."""

import hashlib
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from annolake.operators import joins, ordered, splits


@pytest.fixture(scope="module")
def skewed(spark):
    # Key 0 holds about two thirds of the rows; `v` repeats, `id` breaks ties.
    return spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 7).cast("long").alias("k"),
        (F.col("id") * 7919 % 97).alias("v"),
        "id",
    )


def test_rank_matches_window(skewed):
    w = Window.partitionBy("k").orderBy("v", "id")
    expected = {r.id: r.n for r in skewed.select("id", F.row_number().over(w).alias("n")).collect()}
    got = {r.id: r.n for r in ordered.with_rank(skewed, ["k"], ["v", "id"], "n", num_chunks=9).collect()}
    assert got == expected


def test_totals_by_position_matches_window(skewed):
    ranked = ordered.with_rank(skewed, ["k"], ["v", "id"], "n")
    w = Window.partitionBy("k").orderBy("n")
    expected = {r.id: r.s for r in ranked.select("id", F.sum("v").over(w).alias("s")).collect()}
    got = ordered.with_totals_by_position(ranked, ["k"], "n", {"s": F.col("v")}, chunk_rows=100)
    assert {r.id: r.s for r in got.collect()} == expected


def test_lookback_matches_window(skewed):
    ranked = ordered.with_rank(skewed, ["k"], ["v", "id"], "n")
    w = Window.partitionBy("k").orderBy("n")
    plain = ranked.withColumn("d", F.col("id") - F.lag("id").over(w)).withColumn(
        "m", F.sum("d").over(w.rowsBetween(-4, 0))
    )
    chunked = ordered.with_lookback(
        ranked, ["k"], "n", 6,
        {"d": lambda x: F.col("id") - F.lag("id").over(x), "m": lambda x: F.sum("d").over(x.rowsBetween(-4, 0))},
        chunk_rows=50,
    )
    rows = lambda df: sorted(map(tuple, df.select("id", "d", "m").collect()))
    assert rows(chunked) == rows(plain)


def test_distribution(skewed):
    values = {}
    for r in skewed.collect():
        values.setdefault(r.k, []).append(r.v)
    got = {r.k: r for r in ordered.value_distribution(skewed, ["k"], "v").collect()}
    for k, v in values.items():
        assert (got[k]["count"], got[k].median) == (len(v), statistics.median(v))
        assert got[k].mean == pytest.approx(statistics.mean(v))
    empty = ordered.value_distribution(skewed.filter("id < 0"), [], "v").first()
    assert empty["count"] == 0 and empty.median is None and empty.mean is None


def test_identity_digest_of_one_run_is_the_hash_of_its_digest(spark):
    rows = spark.createDataFrame([("test", f"train2017:{i:012d}") for i in (42, 9, 7)], "split string, key string")
    text = "\n".join(sorted(r.key for r in rows.collect())) + "\n"
    digest = splits.identity_digest(rows, "split", "key").first()
    leaf = hashlib.sha256(text.encode()).hexdigest()
    assert digest.sha256 == hashlib.sha256(f"{leaf}\n".encode()).hexdigest() and digest["count"] == 3


def test_identity_digest_tree(spark):
    keys = [f"k{i:03d}" for i in range(25)]
    rows = spark.createDataFrame([("a", k) for k in reversed(keys)], "split string, key string")
    level = keys
    while True:
        level = [
            hashlib.sha256(("\n".join(level[i : i + 4]) + "\n").encode()).hexdigest() for i in range(0, len(level), 4)
        ]
        if len(level) == 1:
            break
    assert splits.identity_digest(rows, "split", "key", chunk=4).first().sha256 == level[0]


def test_identity_digest_of_a_short_group_beside_a_long_one(spark):
    rows = [("long", f"k{i:03d}") for i in range(25)] + [("short", "b"), ("short", "a")]
    frame = spark.createDataFrame(rows, "split string, key string")
    got = {r.split: r.sha256 for r in splits.identity_digest(frame, "split", "key", chunk=4).collect()}
    alone = splits.identity_digest(frame.filter("split = 'long'"), "split", "key", chunk=4).first()
    leaf = hashlib.sha256(b"a\nb\n").hexdigest()
    assert got == {"short": hashlib.sha256(f"{leaf}\n".encode()).hexdigest(), "long": alone.sha256}


def test_label_lines_of_usual_images_need_no_checkpoint(spark, monkeypatch):
    boxes = [(s, i, a, 0.5) for s, i, n in (("a", 1, 9), ("a", None, 3), (None, 2, 4), ("b", 3, 1)) for a in range(n)]
    rows = spark.createDataFrame([(*b, "accepted" if b[2] != 5 else "rejected") for b in boxes], "source_split string, image_id long, annotation_id long, v double, status string")
    yolo = F.struct(*[F.col("v").alias(c) for c in ("xc", "yc", "w", "h")])
    classified = rows.select("*", F.lit(0).cast("long").alias("class_id"), yolo.alias("yolo")).repartition(3)
    made, cut = [], ordered.cut_lineage
    monkeypatch.setattr(ordered, "cut_lineage", lambda df: made.append(1) or cut(df))
    want = sorted((str(s), str(i), a, a + 1 - (a > 5)) for s, i, a, _ in boxes if a != 5)
    read = lambda df: sorted((str(r.source_split), str(r.image_id), r.annotation_id, r.pos) for r in df.collect())
    assert read(joins.label_lines_from(classified)) == want and not made
    kept = rows.filter("status = 'accepted'").select("source_split", "image_id", "annotation_id")
    assert read(ordered.with_usual_rank(kept, ["source_split", "image_id"], ["annotation_id"], "pos", most=3)) == want and made
