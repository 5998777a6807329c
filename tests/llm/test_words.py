"""Collocations, packing and alignment against plain Python on small tables with odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from annolake.llm import alignment, collocations, packing
from annolake.llm.substring import split_words
from annolake.llm.wordcodes import coded, gathered

SCHEMA = "doc_id long, text string, lang string, row long, page long, ids int, length int, key string, n_a int, _k0 int"


def _words(rng, count, letters="abcdeß", longest=9):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(count))


ODD = [
    None, "", " ", "a", " lead", "trail ", "two  blanks here", "nl\nx y\n\nz w", "\nstart it", "end it\n", "tab\there x", "▁x a",
    "<|endoftext|> a<|endoftext|>b <s> c</s>", "a\xa0b c d", "日本語 テキスト 😀 ok", "é é ﬁ İ ΑΣ", "x\x00y z\x1cq \x1c r",
    "don't 'll we'll 123 45", "x" * 5000, "a " * 300 + "b", " \n\t ",
]


def _rows():
    rng = random.Random(4)
    texts = list(enumerate(ODD)) + [(100 + i, _words(rng, rng.randint(1, 80), "abcdeéß,.") + rng.choice(["", " ", "\n", "\n\n"])) for i in range(40)]
    texts += [texts[-1], texts[-1], (None, texts[-2][1]), (300, _words(rng, 6000))]
    return [(i, t, None if (i or 0) % 7 == 0 else "en", 1, 2, 3, 4, "k", 5, 6) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _plain_collocations(rows, least):
    counts = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            for size in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n, found = sum(c for p, c in f.items() if len(p) == 1), []
        frequent = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        for p, a in frequent.items():
            if len(p) == 2 and any(100 * c >= 50 * a for q, c in frequent.items() if len(q) == 3 and p in (q[:2], q[1:])):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:2000], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def _phrases(rng):
    rows = []
    for i in range(120):
        words = rng.choices(["The", "the", "of", "new York", "new york city", "x", "é", "a-b", "New york,", "q\t"], k=rng.randint(0, 40))
        rows.append((i, " ".join(words), rng.choice(["en", None, "und", ""]), 1, 2, 3, 4, "k", 5, 6))
    return rows + [rows[0], (None, None, None, *rows[0][3:])]


def test_collocations_hold_one_page_at_a_time(spark, monkeypatch):
    """Nothing is collected for a page, and what was found for it may lie in several batches."""
    monkeypatch.setattr(collocations.F, "collect_list", lambda *_: pytest.fail("a list for each page of a task"))
    monkeypatch.setattr(collocations, "PAGE_BYTES", 200)
    rows = [(i, "en" if i % 2 else None, f"a b c. a b d{i % 3} a b c") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = sorted(map(tuple, collocations.collocations(frame).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == _plain_collocations([(i, text, lang) for i, lang, text in rows], 10) and got


def test_collocations_equal_plain_counts(spark, none):
    rows = _phrases(random.Random(7))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(map(tuple, collocations.collocations(frame).collect()))
    assert got == _plain_collocations(rows, 10) and len(got) > 20
    everything = collocations.collocations(frame, least=1, top=None)
    assert sorted(map(tuple, everything.collect())) == _plain_collocations(rows, 1)
    assert collocations.collocations(none).collect() == []


def test_two_rounds_of_merging_and_small_pages(spark, monkeypatch):
    rows = _phrases(random.Random(8))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    monkeypatch.setattr(collocations.counted_pairs, "__defaults__", (2,))
    monkeypatch.setattr(collocations, "HELD_BYTES", 100)
    assert sorted(map(tuple, collocations.collocations(frame, least=2).collect())) == _plain_collocations(rows, 2)


def test_score_is_exact_beyond_64_bits(spark):
    rows = [(10**12 + 7, 3 * 10**12, 2 * 10**12 + 1), (10**15 - 1, 10**15 - 1, 10**15 - 1), (10, 10, 10), (10, 1999, 10)]
    frame = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in frame.select(collocations._score(frame.a, frame.l, frame.r)).collect()]
    assert got == [1_000_000 * a * a // (x * y) for a, x, y in rows]


def test_dense_and_sparse_tiles_count_alike(monkeypatch):
    rng = np.random.default_rng(3)
    left, right = rng.zipf(1.3, 50_000) % 5000, rng.zipf(1.3, 50_000) % 5000
    want = Counter(zip(left.tolist(), right.tolist(), strict=True))
    for share in (1e-6, 1 / 512, 2.0):
        monkeypatch.setattr(collocations, "DENSE_SHARE", share)
        tiles = collocations.Tiles()
        for part in np.array_split(np.arange(50_000), 7):
            tiles.add(np.sort(tiles.code(left[part], right[part])))
        codes, counts = tiles.take()
        pairs = zip(*(x.tolist() for x in tiles.pair(codes)), strict=True)
        assert dict(zip(pairs, counts.tolist(), strict=True)) == want and (np.diff(codes) > 0).all()


def _tokens(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_packing_places_every_piece(docs, none):
    tokenizer = packing.load_tokenizer(packing.TOKENIZER)
    out = packing.pack_documents(docs, ["doc_id"], capacity=256, grain=16).collect()
    want = Counter()
    for doc_id, text, *_ in _rows():
        ids = _tokens(tokenizer, text)
        want.update((doc_id, at // 256, at, tuple(ids[at : at + 256])) for at in range(0, len(ids), 256))
    assert Counter((r.doc_id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in out) == want
    assert all(r.length == len(r.ids) // 4 for r in out)
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(held)]).tolist()]
        assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= 256
    assert len(sequences) <= -(-sum(r.length for r in out) // 256) + 2
    assert packing.pack_documents(none, ["doc_id"]).count() == 0
    first = packing.pack_documents(docs.filter("doc_id = 0"), ["doc_id"]).select("length", packing.F.crc32("ids").alias("c")).first()
    assert tuple(first) == (1, zlib.crc32(bytes(4)))


def test_word_encoder_equals_the_tokenizer():
    texts = pa.array([t or "" for t in ODD])
    words, bounds = split_words(texts)
    known, codes = coded(words)
    flat, begins, counts = packing.WordEncoder(packing.TOKENIZER).encode(known)
    tokenizer = packing.load_tokenizer(packing.TOKENIZER)
    for i, text in enumerate(texts.to_pylist()):
        own = codes[bounds[i] : bounds[i + 1]]
        assert flat[gathered(begins[own], counts[own])].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("spread,most", [(1.0, 1.002), (0.3, 1.02)])
def test_plan_is_near_the_bound(spread, most):
    rng = np.random.default_rng(0)
    lengths = np.clip(rng.lognormal(6.5, spread, 30_000).astype(int), 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    runs = packing.plan_runs(counts)
    held = np.zeros(2049, np.int64)
    for size, parts in runs:
        assert sum(x * n for x, n in parts) <= 2048
        for x, n in parts:
            held[x] += size * n
    assert (held == counts).all()
    assert sum(n for n, _ in runs) <= most * -(-int(lengths.sum()) // 2048)


def test_non_negative_least_squares_meets_its_conditions():
    rng = np.random.default_rng(5)
    for _ in range(30):
        matrix, target = rng.random((8, 20)), rng.random(8) * 3 - 0.5
        x = packing.non_negative_least_squares(matrix, target)
        gain = matrix.T @ (target - matrix @ x)
        assert (x >= 0).all() and gain.max() < 1e-6 and np.abs(gain[x > 0]).max(initial=0) < 1e-6


def _both_sides():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_TOKENIZER))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECE_TOKENIZER))
    characters, names = alignment.byte_characters(), {i: t for t, i in a.get_vocab().items()}

    def one(text):
        left = [(i, bytes(characters[c] for c in names[i])) for i in a.encode(f" {text}", add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        same = all(b"".join(x for _, x in side) == f" {text}".encode() for side in (left, right))
        return (left, right) if text and same else ([], [])

    return one


def _placed(side):
    ends = np.cumsum([len(x) for _, x in side]).tolist()
    return [(i, end - len(x), end) for (i, x), end in zip(side, ends, strict=True)]


def test_alignment_equals_all_pairs(docs, none):
    encode, per, held = _both_sides(), [], Counter()
    for doc_id, text, *_ in _rows():
        if text and len(text) > 20_000:
            continue
        a, b = map(_placed, encode(text or ""))
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        groups, low = [], 0
        for end in sorted({x[2] for x in a} & {y[2] for y in b}):
            sides = (",".join(str(i) for i, _, e in side if low < e <= end) for side in (a, b))
            groups.append("|".join(sides))
            low = end
        per.append((doc_id, len(a), len(b), groups, links))
        held.update(set(links))
    best = defaultdict(int)
    for (left, _), n in held.items():
        best[left] = max(best[left], n)
    want = Counter(
        (i, na, nb, len(g), len(x), sum(held[k] == best[k[0]] for k in x), sum(held[k] for k in x), ";".join(g)) for i, na, nb, g, x in per
    )
    out = alignment.align_documents(docs.filter("doc_id is null or doc_id <> 300"), ["doc_id"])
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert Counter(map(tuple, out.collect())) == want
    assert alignment.align_documents(none, ["doc_id"]).count() == 0


def test_groups_of_intervals_with_gaps():
    starts, ends = np.array([5, 0, 3, 9]), np.array([7, 4, 5, 12])
    order, first = alignment.coalesced(starts, ends)
    assert order.tolist() == [1, 2, 0, 3] and first.tolist() == [True, False, True, True]
    a, b = alignment.overlaps(np.array([0, 4]), np.array([4, 6]), np.array([0, 2, 6]), np.array([2, 6, 7]))
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == [(0, 0), (0, 1), (1, 1)]
