"""Operators on one small table with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from annolake.llm import (
    components, decontaminate, importance, mixing, sharding, simhash, substring, suffixes, tokenbin, versions, warc,
    windows,
)
from annolake.session import staging_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, text_key string, slot int, _row int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _words(rng, count):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(count))


def _rows():
    rng = random.Random(11)
    passage = _words(rng, 80)
    texts = {i: _words(rng, rng.randint(1, 60)) for i in range(24)}
    texts |= {30: passage, 31: _words(rng, 5) + " " + passage, 32: passage + "\n" + passage, 33: passage.replace(" ", "\n", 3)}
    texts |= {40: "", 41: None, 42: "   \t\n", 43: "the the " * 900, 44: texts[3], 45: texts[3], 46: texts[3].upper()}
    texts |= {47: texts[5] + " Extra", 48: _words(rng, 3000), 49: "x"}
    rows = [(i, t, None, None if i % 5 == 0 else f"s{i % 3}", 1, -i, "k", "c", 9, 4) for i, t in texts.items()]
    return [*rows, (None, passage, "de", "s1", None, 1, "k", None, 0, 0), rows[3], rows[3]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _text(row):
    return row[1] or ""


def _order(row):
    return 2**63 if row[0] is None else row[0]


def test_warc_round_trip(spark):
    html = ["a" * 1200, "b" * 40_000, "c" * 10, None, "é" * 20_000]
    pages = [(i, f"http://h/{i}" if i % 2 else None, html[i % 5], "x") for i in range(20)] + [(None, None, html[0], "y")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, payload string")
    path = warc.write_archive(frame, staging_path(spark, "t"))
    rows = {r.page_id: r for r in warc.read_pages(spark, path).collect()}
    assert all(r.problem is None for r in rows.values()) and len(rows) == 21
    for i in range(20):
        data = (html[i % 5] or "").encode()
        assert rows[i].payload_digest == hashlib.sha1(data).hexdigest()
        later = len(data) >= 1000 and i < 15
        assert (rows[i].kind, rows[i].refers_to) == (("revisit", 15 + i % 5) if later else ("response", None))
        assert later or bytes(rows[i].payload) == data
    assert rows[None].kind == "response"
    cut = warc.read_records(spark, path).filter("number is null or number <> 2")
    problems = {r.problem for r in warc.reassemble(cut).collect()}
    assert problems == {None, "missing segment"}
    empty = warc.write_archive(frame.limit(0), staging_path(spark, "t"))
    assert warc.read_pages(spark, empty).count() == 0


def test_sharding(docs, none):
    rows = sharding.assign_shards(docs, "doc_id", [1.0] * 4).collect()
    assert len(rows) == len(_rows())
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 4)
        scores = []
        for s in range(4):
            bits = xxhash.xxh64_intdigest(f"{'' if r.doc_id is None else r.doc_id}:{s}".encode(), 42) & (2**53 - 1)
            scores.append((-1 / np.log((bits + 0.5) / 2**53), s))
        assert r["shard"] == max(scores)[1]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(none, "doc_id", [1.0, 2.0]).count() == 0


def test_weighted_shards(spark):
    frame = spark.range(4000).withColumnRenamed("id", "k")
    counts = {r["shard"]: r["n"] for r in sharding.assign_shards(frame, "k", [1.0, 3.0, 0.0]).groupBy("shard").count().withColumnRenamed("count", "n").collect()}
    assert set(counts) == {0, 1} and 2800 < counts[1] < 3200


def test_importance_keeps_good_and_drops_bad(spark, none):
    rng = random.Random(2)
    good = [(i, _words(rng, 40) + ".") for i in range(150)]
    bad = [(1000 + i, " ".join(w + "***" for w in _words(rng, 40).split())) for i in range(60)]
    frame = spark.createDataFrame([*good, *bad, (2000, None), (2001, ""), good[0]], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, 1) for i in range(75)] + [(1000 + i, 0) for i in range(30)] + [(None, 1), (3, None)], "doc_id long, quality int"
    )
    out = importance.importance_sample(frame, labels, ["doc_id"]).collect()
    kept = {r.doc_id for r in out if r.selected}
    assert len(out) == 213 and sorted(r["rank"] for r in out) == list(range(1, 214))
    assert len({i for i, _ in good} - kept) <= 1 and len([i for i in kept if 1000 <= i < 2000]) <= 1  # half of them held out
    assert importance.importance_sample(none, labels, ["doc_id"]).count() == 0
    assert all(r.selected for r in importance.importance_sample(frame, labels.limit(0), ["doc_id"]).collect())


def test_importance_against_plain_counts(docs, spark):
    rows = [(_order(r), _text(r)) for r in _rows() if r[0] is not None]
    good = {i: int(i % 3 > 0) for i, _ in rows if i % 2 == 0}
    labels = spark.createDataFrame(list(good.items()), "doc_id long, quality int")
    out = importance.importance_sample(docs.filter("doc_id IS NOT NULL"), labels, ["doc_id"]).collect()

    def buckets(text):
        tokens = re.findall(r"\w+|[^\w\s]+", text)
        values = [xxhash.xxh3_64_intdigest(t.encode()) for t in tokens]
        pairs = [0xD1B54A32D192ED03 if a == b else (a * 0x9E3779B97F4A7C15 + b) % 2**64 for a, b in zip(values, values[1:], strict=False)]
        return [int(windows.mix(np.array([v], np.uint64))[0]) % importance.BUCKETS for v in values + pairs]

    raw, target = defaultdict(lambda: 1), defaultdict(lambda: 1)
    held = [(i, buckets(text)) for i, text in rows]
    for i, found in held:
        for b in found:
            raw[b] += 1
            target[b] += good.get(i, 0)
    n_raw, n_target = (importance.BUCKETS + sum(v - 1 for v in m.values()) for m in (raw, target))
    score = {i: sum(np.log(target[b] / n_target * n_raw / raw[b]) for b in found) / max(len(found), 1) for i, found in held}
    for r in out:
        assert r.score == pytest.approx(score[r.doc_id], abs=1e-9)
    labelled = [(score[i], good[i]) for i, _ in rows if i in good]

    def accuracy(cut):
        return np.mean([s >= cut for s, g in labelled if g]) + np.mean([s < cut for s, g in labelled if not g])

    cuts = sorted({s for s, _ in labelled})
    middles = [-np.inf, *((a + b) / 2 for a, b in zip(cuts, cuts[1:], strict=False)), np.inf]
    best = max(map(accuracy, middles))
    sizes = {sum(score[i] >= c for i, _ in rows) for c in middles if accuracy(c) > best - 1e-9}
    taken = [r for r in out if r.selected]
    assert len(taken) in sizes
    assert min(r.gumbel_key for r in taken) >= max((r.gumbel_key for r in out if not r.selected), default=-np.inf)


def test_simhash_components(docs, none):
    out = simhash.near_duplicates(docs, ["doc_id"]).collect()
    prints = defaultdict(list)
    for r in out:
        prints[r["print"] % 2**64].append((r.doc_id, r.component_id))
    texts = {r[0]: _text(r) for r in _rows()}
    for value, members in prints.items():
        for i, _ in members:
            lowered = re.sub("[A-Z]", lambda m: m[0].lower(), texts[i])
            words = WORD.findall(lowered)
            shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
            counts = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
            assert value == sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))
    values = list(prints)
    label = {v: v for v in values}
    for _ in values:
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
    for value, members in prints.items():
        reach = [i for v in values if label[v] == label[value] for i, _ in prints[v] if i is not None]
        assert {c for _, c in members} == {min(reach)}
    assert simhash.near_duplicates(none, ["doc_id"]).count() == 0


def test_link_blocks_and_components(spark):
    rng = random.Random(4)
    base = rng.getrandbits(64)
    near = {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)} | {rng.getrandbits(64) for _ in range(40)}
    frame = spark.createDataFrame([((p + 2**63) % 2**64 - 2**63,) for p in near], "print long")
    both = [simhash.print_links(frame, block=size) for size in (2048, 16)]
    found = [{(r.node, r.root) for r in components.connected_components(e).collect()} for e in both]
    assert found[0] == found[1] and len(found[0]) >= 50


def test_near_copies(docs, none):
    rows = {r.doc_id: r for r in simhash.near_copies(docs, ["doc_id"]).collect()}
    assert rows[44].component_id == rows[45].component_id == 3
    assert rows[40].component_id == rows[41].component_id == rows[42].component_id == 40
    assert rows[10].component_id == 10
    assert simhash.near_copies(none, ["doc_id"]).count() == 0


@pytest.mark.parametrize("lanes", [1, 2])
def test_window_removal(docs, none, lanes):
    first = {}
    for row in _rows():
        words = WORD.findall(_text(row))
        for k in range(len(words) - 49):
            key = tuple(words[k : k + 50])
            first[key] = min(first.get(key, 2**64), _order(row))
    want = defaultdict(list)
    for row in _rows():
        words, drop = WORD.findall(_text(row)), set()
        for k in range(len(words) - 49):
            if first[tuple(words[k : k + 50])] < _order(row):
                drop |= set(range(k, k + 50))
        want[row[0]].append((len(words), len(drop), " ".join(w for k, w in enumerate(words) if k not in drop)))
    got = defaultdict(list)
    for r in substring.remove_repeats(docs, lanes=lanes).collect():
        got[r.doc_id].append((r.n_words, r.n_removed, r.kept))
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert substring.remove_repeats(none).count() == 0


@pytest.mark.parametrize("group", [256, 2])
def test_string_removal(docs, none, group, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP", group)
    monkeypatch.setattr(suffixes, "PAGE_BYTES", 5000 if group == 2 else 1 << 20)
    first = {}
    for row in _rows():
        data = _text(row).encode()
        for k in range(len(data) - 99):
            first[data[k : k + 100]] = min(first.get(data[k : k + 100], (2**64, 0)), (_order(row), k))
    want = defaultdict(list)
    for row in _rows():
        data = _text(row).encode()
        drop = set()
        for k in range(len(data) - 99):
            if first[data[k : k + 100]] < (_order(row), k):
                drop |= set(range(k, k + 100))
        runs = sum(1 for k in drop if k - 1 not in drop)
        want[row[0]].append((len(data), len(drop), runs, bytes(b for k, b in enumerate(data) if k not in drop)))
    got = defaultdict(list)
    for r in suffixes.remove_repeated_strings(docs).collect():
        got[r.doc_id].append((r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert suffixes.remove_repeated_strings(none).count() == 0


def test_contamination_and_proximity(spark, docs, none):
    rows = _rows()
    long_, short = WORD.findall(rows[24][1])[:30], "x"
    items = spark.createDataFrame(
        [("a", " ".join(long_).upper().replace("É", "é")), ("b", short), ("c", None), ("d", "..."), ("e", "not there at all"), ("a", short)],
        "item_id string, text string",
    )
    out = {}
    for r in decontaminate.contamination(docs, items).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert len(out[3]) == 3 and out[41][0].n_words == 0 and out[41][0].n_hit == 0
    assert out[30][0].n_hit == 30 and out[30][0]["items"] == ["a"] and out[None][0].n_hit == 30
    assert out[49][0]["items"] == ["a", "b"] and out[49][0].n_hit == 1
    assert out[32][0].n_hit == 60
    assert decontaminate.contamination(none, items).count() == 0
    assert all(r.n_hit == 0 for r in decontaminate.contamination(docs, items.limit(0)).collect())
    texts = spark.createDataFrame([(1, "q one two w three"), (2, "one " + "z " * 30 + "two three"), (3, "three two one")], "doc_id long, text string")
    wanted = decontaminate.phrases(spark.createDataFrame([("p", "one two three")], "item_id string, text string"))
    index = decontaminate.build_index(texts, wanted.selectExpr("explode(term_list) AS word"))
    near = decontaminate.proximity_matches(index, wanted, reach=6)
    assert sorted(r.id for r in near.collect()) == [1, 3]
    assert decontaminate.phrase_matches(texts, index, wanted).count() == 0


def test_token_files(spark, docs, none):
    path = tokenbin.write_tokens(docs, staging_path(spark, "t"), file_bytes=4000)
    rows = sorted(tokenbin.read_tokens(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    tokenizer = tokenbin.load_tokenizer(tokenbin.TOKENIZER)
    texts = defaultdict(list)
    for row in _rows():
        texts[row[0]].append(_text(row))
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r["ids"])
        options = [tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts[r.doc_id]]
        assert r["ids"] in options and r.ids_crc32 == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r.n_tokens
    assert [r.doc_id for r in rows] == sorted((r[0] for r in _rows()), key=lambda i: -1 if i is None else i)
    assert tokenbin.read_tokens(spark, tokenbin.write_tokens(none, staging_path(spark, "t"))).count() == 0


def test_versions(docs, none):
    pieces = lambda s: set(re.findall(r"[^\n]{1,96}\n*|\n+", s))
    rows = versions.compare_versions(docs).collect()
    assert len(rows) == len(_rows())
    found = {r.doc_id: r for r in rows}
    ordered = sorted({(_order(r), _text(r)) for r in _rows()})
    for k, (order, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = found[None if order == 2**63 else order]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = pieces(text), pieces(other)
            assert near == pytest.approx(1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0)
    assert found[3].fingerprint == found[44].fingerprint != found[46].fingerprint
    assert versions.compare_versions(none).count() == 0


def test_mixing(docs, none, spark):
    rows = [(r[0], r[3], len(WORD.findall(_text(r)))) for r in _rows()]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = mixing.balanced_copies(frame, ["doc_id"]).collect()
    again = mixing.balanced_copies(frame.repartition(5), ["doc_id"]).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    times = defaultdict(int)
    for r in rows:
        times[r] += 1
    taken, sizes = defaultdict(int), defaultdict(int)
    for r in out:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r["size"] * r.rows
        times[r.doc_id, r.source, r["size"]] -= r.rows
        sizes[r.source] = r.source_size
    weights = dict(zip([*sorted(s for s in sizes if s is not None), None], [1, 2, 3, 1], strict=True))
    target, full, left = {}, set(), sum(sizes.values())
    while True:
        share = {s: left * weights[s] / sum(w for t, w in weights.items() if t not in full) for s in sizes if s not in full}
        more = {s for s in share if share[s] > 3 * sizes[s]}
        if not more:
            break
        full |= more
        left -= sum(3 * sizes[s] for s in more)
    target = share | {s: 3 * sizes[s] for s in full}
    most = max(r[2] for r in rows)
    for r in out:
        assert r.target == pytest.approx(target[r.source])
    assert not any(times.values())
    for source in sizes:
        assert abs(taken[source] - target[source]) <= most
    assert mixing.balanced_copies(frame.limit(0), ["doc_id"]).count() == 0
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies * r.rows for r in out)
    assert mixing.mix_documents(none).count() == 0


def test_equal_rows_are_mixed_to_the_target(spark):
    rows = [(1, "a a a", "a", 0)] * 2500 + [(2 + i, "b " * 50, "b", 0) for i in range(75)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _total int")
    frame = docs.selectExpr("doc_id", "source", "CASE source WHEN 'a' THEN 3L ELSE 50L END AS size")
    copies = mixing.balanced_copies(frame, ["doc_id"]).filter("source = 'a'").collect()
    target = (7500 + 3750) / 3
    assert abs(sum(r.rows * r.copies * 3 for r in copies) - target) <= 3
    assert sum(r.rows for r in copies) == 2500 and max(r.copies for r in copies) - min(r.copies for r in copies) <= 1
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert abs(3 * mixed.filter("source = 'a' AND text = 'a a a' AND doc_id = 1 AND _total = 0").count() - target) <= 3


def test_tokens_are_read_from_their_place(spark, docs):
    path = tokenbin.write_tokens(docs, staging_path(spark, "t"), file_bytes=4000)
    rows = sorted(tokenbin.read_tokens(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).orderBy("path").collect() if r.content]
    ids, at = np.concatenate([r["ids"] for r in rows]), 0
    for content in files:
        asked = []

        def read(offset, length, content=content, asked=asked):
            asked.append(length)
            return content[offset : offset + length]

        count = sum(int(counts.sum()) for *_, counts, _ in tokenbin.blocks(content))
        for start, stop in ((0, 0), (0, 1), (count - 1, count), (count // 3, count // 2), (0, count)):
            assert (tokenbin.read_range(read, len(content), start, stop) == ids[at + start : at + stop]).all()
        asked.clear()
        assert tokenbin.read_token(content, count // 2) == ids[at + count // 2]
        tokenbin.read_range(read, len(content), count // 2, count // 2 + 1)
        assert sum(asked) < 400
        with pytest.raises(IndexError):
            tokenbin.read_token(content, count)
        at += count
    assert at == len(ids)


def _shared_passage(count, passage):
    rng = random.Random(8)
    return [(i, f"{_words(rng, 60)} {passage} {_words(rng, 60)}") for i in range(count)]


def test_windows_of_a_hot_anchor_are_split(spark, monkeypatch):
    rng = random.Random(1)
    while True:  # a line whose gram is the smallest of nearly all windows around it
        line = _words(rng, 12)
        values = substring.word_values(substring.split_words(pa.array([line]))[0])
        if windows.Rolling(values).all(substring.GRAM).min() < 2**64 // 1000:
            break
    frame = spark.createDataFrame([*_shared_passage(60, line), *((100 + i, t) for i, t in _shared_passage(3, line))], "doc_id long, text string")
    want = sorted(map(str, substring.remove_repeats(frame).collect()))
    monkeypatch.setattr(substring, "LIMIT", 200, raising=False)
    assert sorted(map(str, substring.remove_repeats(frame).collect())) == want

    def sizes(window, lanes):
        def run(batches):
            for rows in substring.by_bucket(batches, ["docs", "runs", "hashes"]):
                held = sum(len(h) // 8 for *_, h in rows if h is not None)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((held, "int64"), (0, "int64"), (0, "int32"), (0, "int32"))], ["id", "key", "start", "stop"])

        return run

    monkeypatch.setattr(substring, "_counter", sizes)
    held = [r.id for r in substring.repeated_windows(frame).collect()]
    assert sum(held) > 4000 and max(held) <= 400


def test_fragments_of_a_hot_anchor_are_split(spark, monkeypatch):
    rng = random.Random(1)
    frame = spark.createDataFrame([*_shared_passage(60, _words(rng, 40)), (100, _shared_passage(1, "")[0][1])], "doc_id long, text string")
    want = sorted(map(str, suffixes.remove_repeated_strings(frame).collect()))
    monkeypatch.setattr(suffixes, "GROUP", 8)
    assert sorted(map(str, suffixes.remove_repeated_strings(frame).collect())) == want
    monkeypatch.setattr(suffixes, "LIMIT", 20, raising=False)
    assert sorted(map(str, suffixes.remove_repeated_strings(frame).collect())) == want

    def sizes(length):
        def run(batches):
            renamed = (b.rename_columns(["bucket", *b.schema.names[1:]]) for b in batches)
            for rows in substring.by_bucket(renamed, ["data"]):
                held = sum(len(data) for _, data in rows)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((held, "int64"), (0, "int64"), (0, "int32"), (0, "int32"))], ["id", "key", "start", "stop"])

        return run

    monkeypatch.setattr(suffixes, "LIMIT", 1 << 40, raising=False)
    monkeypatch.setattr(suffixes, "_sorter", sizes)
    held = [r.id for r in suffixes.repeated_strings(frame).collect() if r.key == r.start == r.stop == 0]
    assert max(held, default=0) <= 8 * 150


def test_near_copies_are_the_pairs_at_the_exact_similarity(spark):
    rng = random.Random(6)
    texts = {}
    for family in range(12):  # templates whose members lie on both sides of 0.8
        base = _words(rng, 240).split()
        for member in range(10):
            words = list(base)
            at = rng.randrange(len(words))
            for k in range(at, at + rng.randint(0, 40)):
                words[k % len(words)] = _words(rng, 1)
            texts[100 * family + member] = " ".join(words)
    texts |= {5000: "a b c", 5001: "a b c", 5002: "a b d", 5003: "", 5004: None}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").split()) else set() for i, t in texts.items()}
    label = {i: i for i in texts}
    pairs = [(a, b) for a in sets for b in sets if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))]
    for _ in range(10):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in simhash.near_copies(frame, ["doc_id"]).collect()} == label
    assert len(set(label.values())) > 20


def test_near_copies_compare_a_set_once_a_round(spark, monkeypatch):
    rng = random.Random(9)
    base, texts = _words(rng, 100).split(), []
    for _ in range(400):  # one template, all pairs below 0.8
        words = list(base)
        for k in rng.sample(range(100), 6):
            words[k] = _words(rng, 1)
        texts.append(" ".join(words))
    asked, verified = [], simhash.verified_pairs

    def counted(pairs, *rest):
        asked.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(simhash, "verified_pairs", counted)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = simhash.near_copies(frame, ["doc_id"]).collect()
    assert len(rows) == 400 and len(asked) >= 3
    assert all(n <= 400 for n in asked[1:]) and asked[0] <= 2 * 400
