"""The pipeline stage by stage on the smallest driver tables."""

import os

import pytest

import corpus_pipeline
from annolake.llm import decontaminate
from annolake.llm.common import table
from annolake.session import staging_path

FOLDER = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, _row int, _key string, _mark int, "
    "_id long, _copy int, copies int, node long, root long, class int, key string, rank int, _wanted_id int, _hit_key int"
)
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


def test_each_stage_works_on_what_the_one_before_kept(spark):
    docs = table(spark, FOLDER, "documents")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = staging_path(spark, "t")
        out = stage(spark, docs, FOLDER)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        kept[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontaminate", "mix", "tokens"]
    good = {r.doc_id for r in kept["quality"]}
    assert {i for i, q in labels.items() if q == 1} - good == set()
    texts = [r.text for r in kept["near_duplicates"]]
    assert len(texts) == len(set(texts)) and {r.text for r in kept["quality"]} >= set(texts)
    clean = spark.createDataFrame(kept["decontaminate"], "doc_id long, text string, lang string, source string, n_chars long")
    found = decontaminate.contamination(clean, table(spark, FOLDER, "benchmark"))
    assert found.filter("n_hit > 0").count() == 0
    assert {r.doc_id for r in kept["mix"]} <= {r.doc_id for r in kept["decontaminate"]}
    assert len(kept["tokens"]) == len(kept["mix"]) == before.count()
    ends = sorted((r.start, r.n_tokens) for r in kept["tokens"])
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:], strict=False))


def test_stages_keep_nulls_repeats_and_clashing_columns(spark):
    passage = table(spark, FOLDER, "benchmark").first().text
    spread = " ".join(f"w{i}" for i in range(90))
    texts = {1: spread, 2: spread, 3: spread + " more", 4: None, 5: "", 6: " \t\n", 7: "x " * 20_000, 8: passage + " " + spread, None: "lone words"}
    rest = [7, "k", 8, 9, 10, 11, 12, 13, 14, "y", 15, 16, 17]
    rows = [(i, t, "en", None if i == 2 else "s", None, *rest) for i, t in texts.items()]
    docs = spark.createDataFrame([*rows, rows[0], rows[0]], SCHEMA).repartition(3)
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        after[name] = out.collect()
        assert all(tuple(r)[5:] == tuple(rest) for r in after[name])
        assert {tuple(r) for r in after[name]} <= {tuple(r) for r in rows}
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    assert sorted(r.doc_id for r in after["near_duplicates"] if r.doc_id) == [1, 4, 7, 8]
    assert [r.text for r in after["near_duplicates"] if r.doc_id is None] == ["lone words"]
    assert sorted(str(r.doc_id) for r in after["decontaminate"]) == sorted([*map(str, [1, 1, 1, 2, 3, 4, 5, 6, 7]), "None"])
    ended = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert ended.count() == len(rows) + 2
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), FOLDER).count() == 0
