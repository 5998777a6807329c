"""Near copies: no link between texts that are alike enough is left out."""

import random

from annolake.llm import simhash


def test_links_are_whole_whatever_the_rounds(spark):
    draw = random.Random(5)
    texts = []
    for family in range(4):
        base = [f"f{family}w{draw.randrange(10_000)}" for _ in range(80)]
        for _ in range(8):
            words = list(base)
            for at in draw.sample(range(80), draw.randrange(4)):
                words[at] = f"x{draw.randrange(10**6)}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.mapInArrow(simhash._set_batches(5), "doc_id long, node long, print long, text string").collect()
    sets = {r.node: set(simhash.shingle_set(texts[r.doc_id], 5).tolist()) for r in rows}
    alike = {(a, b) for a in sets for b in sets if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    classes = {}
    for node in sets:
        reached, todo = {node}, [node]
        while todo:
            here = todo.pop()
            new = {b for a, b in alike if a == here} - reached
            reached |= new
            todo += new
        classes[node] = min(reached)
    assert len(set(classes.values())) < len(sets)
    made = spark.createDataFrame([(r.node, r.print, r.text) for r in rows if r.text is not None], "node long, print long, text string")
    found = {r.node: r.root for r in simhash.copy_links(made, rounds=0).collect()}
    for a in sets:
        for b in sets:
            assert (found.get(a, a) == found.get(b, b)) == (classes[a] == classes[b])


def test_settled_tables_leave_nothing_else(spark, tmp_path, monkeypatch):
    from annolake.llm import common

    paths = iter(range(9))
    monkeypatch.setattr(common, "staging_path", lambda _, name: str(tmp_path / f"{name}{next(paths)}"))
    made = common.settled(spark, "made", lambda: common.stage(common.stage(spark.range(5), "one"), "two").filter("id > 2"))
    assert sorted(r.id for r in made.collect()) == [3, 4]
    assert [p.name[:4] for p in tmp_path.iterdir()] == ["made"]


def test_pairs_left_are_those_that_sketches_allow(spark, monkeypatch):
    """One template: sets share many keys, but hardly any pair is alike enough to be looked at."""
    draw = random.Random(3)
    base, texts = [f"w{i}" for i in range(400)], []
    for _ in range(60):
        words = list(base)
        for at in draw.sample(range(400), 16):  # some 60 % in common
            words[at] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(words))
    texts.append(texts[0] + " end")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = docs.mapInArrow(simhash._set_batches(5), "doc_id long, node long, print long, text string").select("node", "print", "text").cache()
    asked, verified = [], simhash.verified_pairs
    monkeypatch.setattr(simhash, "verified_pairs", lambda pairs, *rest: asked.append(pairs.count()) or verified(pairs, *rest))
    found = {r.node: r.root for r in simhash.copy_links(made, rounds=0).collect()}
    assert len(found) == 2 and len(set(found.values())) == 1
    assert sum(asked[1:]) < 60
