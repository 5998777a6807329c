"""Frequent phrases of two and three words, per language.

Words of a language are ranked by frequency and the ranks of frequent ones become ids.  The pairs of an
id matrix are counted in square tiles of ``TILE`` ids: a crowded tile with a dense bincount, a sparse one as sorted
coordinates with counts.  Frequent pairs are ranked again, and pairs of a pair and the word after it, counted
the same way, are the phrases of three words.

Texts travel as pages of word codes with a list of each page's different words; ids come back to the
pages by joins on those lists, so what a join moves grows with vocabulary per page and not with words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolake.llm.common import stage, table, text_or_empty
from annolake.llm.windows import mix, new_values, page_slices, run_bounds
from annolake.llm.wordcodes import coded
from annolake.operators.ordered import with_rank

MIN_COUNT = 10
#: A phrase goes if a longer one around it has this share (percent) of its occurrences.
COVERED_PERCENT = 50
TOP = 2000
NO_LANGUAGE = "und"
PAGE_BYTES = 8 << 20
#: Ids along one side of a tile (2 to this power); share of a tile's cells from which a page counts it densely.
SIDE_BITS = 9
DENSE_SHARE = 1 / 16
#: Bytes of counts that a task keeps before it sends them on.
HELD_BYTES = 48 << 20
#: Buckets for each shuffle partition.
SPREAD = 4
#: Pages whose counts of one bucket meet in one task; more are merged in two rounds.
FAN_IN = 1024

_BLANKS = (0x20, 0x09)
_BREAKS = tuple(b".,;:!?\n\x0b\x0c\r")
_BREAK = -1


def word_stream(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``(words, after)``: all words in order, A-Z lower-cased, and whether a piece begins with each."""
    closed = pc.binary_join_element_wise(texts, "", "\n")  # a text ends its last piece
    data = np.frombuffer(b"".join(closed.cast(pa.binary()).to_pylist()), np.uint8)
    data = np.where((data >= 0x41) & (data <= 0x5A), data + 0x20, data).astype(np.uint8)
    kind = np.zeros(256, np.int8)
    kind[list(_BLANKS)], kind[list(_BREAKS)] = 1, 2
    of = kind[data]
    inside = of == 0
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    breaks = np.cumsum(of == 2)
    piece = breaks[starts] if len(starts) else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes()))
    return words, new_values(piece) if len(piece) else np.zeros(0, bool)


_PAGES = "page long, lang string, words array<string>, counts array<long>, codes binary"


def _pager(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        for low, high in page_slices(batch.column("text"), PAGE_BYTES):
            rows = batch.slice(low, high - low)
            langs = rows.column("lang")
            for lang in pc.unique(langs).to_pylist():
                words, first = word_stream(rows.column("text").filter(pc.equal(langs, lang)))
                known, codes = coded(words)
                stream = np.insert(codes, np.flatnonzero(first), _BREAK).astype(np.int32)
                columns = {
                    "page": pa.array([number], pa.int64()), "lang": pa.array([lang], pa.string()),
                    "words": pa.ListArray.from_arrays([0, len(known)], known),
                    "counts": pa.ListArray.from_arrays([0, len(known)], pa.array(np.bincount(codes, minlength=len(known)))),
                    "codes": pa.array([stream.tobytes()], pa.binary()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
                number += 1


def _numbers(column: pa.Array, row: int, kind: type = np.int32) -> np.ndarray:
    return np.frombuffer(column[row].as_buffer(), kind)


def _gathered(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[list[pa.RecordBatch], pa.RecordBatch, int]]:
    """For every page the parts of batches with what was found for it (columns ``names``, ``own`` 0), and batch and row of
    the page itself (``own`` 1); rows are in the order of ``page, own``."""
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        start = 0
        for row in np.flatnonzero(batch.column("own").to_numpy(zero_copy_only=False)).tolist():
            if row > start:
                parts.append(batch.slice(start, row - start).select(names))
            yield parts, batch, row
            parts, start = [], row + 1
        if start < len(batch):
            parts.append(batch.slice(start).select(names))


def _beside(found: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows of ``found`` and ``pages`` (both with ``page``) as ``_gathered`` reads them.  Sorted, not collected: a sort
    leaves memory for the disk, a list for each of a task's pages does not."""
    rows = found.withColumn("own", F.lit(0)).unionByName(pages.withColumn("own", F.lit(1)), allowMissingColumns=True)
    return rows.repartition("page").sortWithinPartitions("page", "own")


class Tiles:
    """Counts of pairs of ids in tiles: crowded ones dense, all others as sorted cells with counts.

    A cell's code is (row of tile, column of tile, cell in tile), so the cells of a tile are neighbours.
    """

    def __init__(self) -> None:
        self.cells = 1 << (2 * SIDE_BITS)
        self.clear()

    def clear(self) -> None:
        self.dense: dict[int, np.ndarray] = {}
        self.sparse: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = self.bytes = 0

    @staticmethod
    def code(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        low = (1 << SIDE_BITS) - 1
        tile = ((left >> SIDE_BITS) << 22) | (right >> SIDE_BITS)
        return (tile << (2 * SIDE_BITS)) | ((left & low) << SIDE_BITS) | (right & low)

    @staticmethod
    def pair(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = (1 << SIDE_BITS) - 1
        tile = code >> (2 * SIDE_BITS)
        left = ((tile >> 22) << SIDE_BITS) | ((code >> SIDE_BITS) & low)
        return left, ((tile & ((1 << 22) - 1)) << SIDE_BITS) | (code & low)

    def add(self, codes: np.ndarray, counts: np.ndarray | None = None) -> None:
        """Cells in order of code: each with its count, or as often as it occurs."""
        tile = codes >> (2 * SIDE_BITS)
        starts, lengths = run_bounds(new_values(tile)) if len(tile) else (tile, tile)
        rest = np.ones(len(codes), bool)
        crowded = lengths >= self.cells * DENSE_SHARE
        for start, length in zip(starts[crowded].tolist(), lengths[crowded].tolist(), strict=True):
            part = slice(start, start + length)
            if (key := int(tile[start])) not in self.dense:
                self.dense[key] = np.zeros(self.cells, np.int64)
                self.bytes += 8 * self.cells
            weights = None if counts is None else counts[part]
            added = np.bincount(codes[part] & (self.cells - 1), weights, minlength=self.cells)
            self.dense[key] += added.astype(np.int64)  # weights below 2^53 stay exact
            rest[part] = False
        codes = codes[rest]
        if counts is None:
            starts, counts = run_bounds(new_values(codes)) if len(codes) else (codes, codes)
            codes = codes[starts]
        else:
            counts = counts[rest]
        self.sparse.append((codes, counts))
        self.waiting += len(codes)
        self.bytes += 16 * len(codes)
        if self.waiting > max(1 << 20, len(self.sparse[0][0])):
            self._merge()

    def _merge(self) -> None:
        codes, counts = (np.concatenate(x) for x in zip(*self.sparse, strict=True))
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        starts, _ = run_bounds(new_values(codes)) if len(codes) else (codes, codes)
        self.bytes -= 16 * (len(codes) - len(starts))
        self.sparse, self.waiting = [(codes[starts], np.add.reduceat(counts, starts) if len(starts) else counts)], 0

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """All cells in order of code, with counts; afterwards empty."""
        for key, counts in self.dense.items():
            cells = np.flatnonzero(counts)
            self.sparse.append((cells | (key << (2 * SIDE_BITS)), counts[cells]))
        if not self.sparse:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._merge()
        (codes, counts), = self.sparse
        self.clear()
        return codes, counts


_COUNTS = "lang string, bucket int, salt int, codes binary, counts binary"


def _bucketed(lang: str, codes: np.ndarray, counts: np.ndarray, buckets: int, salt: int) -> Iterator[pa.RecordBatch]:
    """One row per bucket; a tile is never split between buckets."""
    bucket = (mix((codes >> (2 * SIDE_BITS)).astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    codes, counts, bucket = codes[order], counts[order], bucket[order]
    starts, lengths = run_bounds(new_values(bucket)) if len(bucket) else (bucket, bucket)
    ends = (starts + lengths).tolist()
    columns = {
        "lang": pa.array([lang] * len(starts), pa.string()), "bucket": pa.array(bucket[starts].astype(np.int32)),
        "salt": pa.array(np.full(len(starts), salt, np.int32)),
        "codes": pa.array([codes[a:b].tobytes() for a, b in zip(starts.tolist(), ends, strict=True)], pa.binary()),
        "counts": pa.array([counts[a:b].astype(np.int64).tobytes() for a, b in zip(starts.tolist(), ends, strict=True)], pa.binary()),
    }
    yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _counter(pairs_of: Callable, buckets: int, salts: int) -> Callable:
    """``pairs_of(batch, row)`` gives a page's pairs of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt, held = TaskContext.get().partitionId() % salts, {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for row, lang in enumerate(langs):
                held.setdefault(lang, Tiles()).add(np.sort(Tiles.code(*pairs_of(batch, row))))
                if sum(t.bytes for t in held.values()) > HELD_BYTES:
                    for key, tiles in held.items():
                        yield from _bucketed(key, *tiles.take(), buckets, salt)
        for key, tiles in held.items():
            yield from _bucketed(key, *tiles.take(), buckets, salt)

    return run


def _merger(buckets: int, least: int | None) -> Callable:
    """Sums the rows of each language, bucket and salt; with ``least`` the frequent pairs leave as rows."""

    def out(key: tuple, tiles: Tiles) -> Iterator[pa.RecordBatch]:
        codes, counts = tiles.take()
        if least is None:
            yield from _bucketed(key[0], codes, counts, buckets, 0)
            return
        codes, counts = codes[counts >= least], counts[counts >= least]
        left, right = Tiles.pair(codes)
        columns = [pa.array([key[0]] * len(codes), pa.string()), pa.array(left), pa.array(right), pa.array(counts)]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "left", "right", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tiles = None, Tiles()
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("lang", "bucket", "salt")), strict=True)
            for row, key in enumerate(keys):
                if last is not None and key != last:
                    yield from out(last, tiles)
                last = key
                tiles.add(_numbers(batch.column("codes"), row, np.int64), _numbers(batch.column("counts"), row, np.int64))
        if last is not None:
            yield from out(last, tiles)

    return run


def counted_pairs(pages: DataFrame, pairs_of: Callable, least: int, fan_in: int = FAN_IN) -> DataFrame:
    """``lang, left, right, n`` of the pairs of ids that all pages hold at least ``least`` times."""
    partitions = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets, salts = partitions * SPREAD, -(-max(1, pages.count()) // fan_in)
    keys = ["lang", "bucket", "salt"]
    tiles = pages.mapInArrow(_counter(pairs_of, buckets, salts), _COUNTS)
    if salts > 1:
        tiles = tiles.repartition(partitions, *keys).sortWithinPartitions(*keys).mapInArrow(_merger(buckets, None), _COUNTS)
    dealt = tiles.repartition(partitions, *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_merger(buckets, least), "lang string, left long, right long, n long")


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for parts, batch, row in _gathered(batches, ["at", "id"]):
        codes = _numbers(batch.column("codes"), row)
        known = np.full(batch.column("size")[row].as_py() + 1, _BREAK, np.int64)  # -1 is the added last one
        for part in parts:
            known[part.column("at").to_numpy(zero_copy_only=False)] = part.column("id").to_numpy(zero_copy_only=False)
        ids = known[codes]
        ids = ids[(ids != _BREAK) | np.append(ids[1:] != _BREAK, False)]  # one break for many
        columns = [batch.column("page").slice(row, 1), batch.column("lang").slice(row, 1), pa.array([ids.astype(np.int32).tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["page", "lang", "ids"])


def _word_pairs(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    ids = _numbers(batch.column("ids"), row).astype(np.int64)
    both = np.flatnonzero((ids[:-1] != _BREAK) & (ids[1:] != _BREAK))
    return ids[both], ids[both + 1]


def _askers(buckets: int) -> Callable:
    """The different pairs of each page, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                codes = np.unique(Tiles.code(*_word_pairs(batch, row)))
                page, lang = batch.column("page")[row].as_py(), batch.column("lang")[row].as_py()
                for part in _bucketed(lang, codes, codes, buckets, 0):
                    columns = [part.column("lang"), part.column("bucket"), pa.array([page] * len(part), pa.int64())]
                    columns += [part.column("codes"), pa.array([None] * len(part), pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "page", "codes", "ids"])

    return run


def _packer(buckets: int) -> Callable:
    """Frequent pairs as rows like those of ``_askers``, with page -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, ids = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("left", "right", "id"))
            langs, codes = batch.column("lang"), Tiles.code(left, right)
            for lang in pc.unique(langs).to_pylist():
                here = pc.equal(langs, lang).to_numpy(zero_copy_only=False)
                for part in _bucketed(lang, codes[here], ids[here], buckets, 0):
                    columns = [part.column("lang"), part.column("bucket"), pa.array([-1] * len(part), pa.int64())]
                    columns += [part.column("codes"), part.column("counts")]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "page", "codes", "ids"])

    return run


def _answerer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes and ids of the frequent pairs among those a page asks for; a bucket's frequent pairs come first."""
    last, parts, known, ids = None, [], None, None
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("lang", "bucket", "page")), strict=True)
        for row, (lang, bucket, page) in enumerate(keys):
            if (lang, bucket) != last:
                last, parts, known = (lang, bucket), [(np.zeros(0, np.int64), np.zeros(0, np.int64))], None
            codes = _numbers(batch.column("codes"), row, np.int64)
            if page == -1:
                parts.append((codes, _numbers(batch.column("ids"), row, np.int64)))
                continue
            if known is None:
                known, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.argsort(known)
                known, ids = known[order], ids[order]
            at = np.searchsorted(known, codes)
            hit = at < len(known)
            hit[hit] = known[at[hit]] == codes[hit]
            if hit.any():
                packed = [pa.array([x.tobytes()], pa.binary()) for x in (codes[hit], ids[at[hit]])]
                yield pa.RecordBatch.from_arrays([pa.array([page], pa.int64()), *packed], ["page", "codes", "pair_ids"])


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent pairs of each page that a word follows with which the pair's last word is frequent too."""
    for parts, batch, row in _gathered(batches, ["codes", "pair_ids"]):
        ids = _numbers(batch.column("ids"), row).astype(np.int64)
        known, pair_ids = (
            np.frombuffer(b"".join(x for part in parts for x in part.column(name).to_pylist()), np.int64) for name in ("codes", "pair_ids")
        )
        order = np.argsort(known)
        known, pair_ids = known[order], pair_ids[order]
        real = (ids[:-1] != _BREAK) & (ids[1:] != _BREAK)
        codes = Tiles.code(np.maximum(ids[:-1], 0), np.maximum(ids[1:], 0))
        at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
        real &= known[at] == codes if len(known) else False
        both = np.flatnonzero(real[:-1] & real[1:])
        columns = [batch.column("page").slice(row, 1), batch.column("lang").slice(row, 1)]
        columns += [pa.array([x.tobytes()], pa.binary()) for x in (pair_ids[at[both]], ids[both + 2].astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, ["page", "lang", "left", "right"])


def _pair_words(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    return _numbers(batch.column("left"), row, np.int64), _numbers(batch.column("right"), row).astype(np.int64)


def frequent_pairs(streams: DataFrame, least: int) -> DataFrame:
    """``lang, left, right, n, id``: frequent pairs of neighbouring words, ids by rank of frequency."""
    pairs = stage(counted_pairs(streams, _word_pairs, least), "pairs")
    ranked = with_rank(pairs, ["lang"], [F.col("n").desc(), "left", "right"], "id")
    return stage(ranked.withColumn("id", F.col("id") - 1), "pairs")


def frequent_triples(streams: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """``lang, left, right, n``: frequent pairs (by id) with the word after them."""
    partitions = int(streams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets, schema = partitions * SPREAD, "lang string, bucket int, page long, codes binary, ids binary"
    asked = streams.mapInArrow(_askers(buckets), schema)
    known = pairs.select("lang", "left", "right", "id").mapInArrow(_packer(buckets), schema)
    dealt = asked.union(known).repartition(partitions, "lang", "bucket").sortWithinPartitions("lang", "bucket", "page")
    answers = dealt.mapInArrow(_answerer, "page long, codes binary, pair_ids binary")
    followed = _beside(answers, streams).mapInArrow(_followed, "page long, lang string, left binary, right binary")
    return counted_pairs(stage(followed, "streams"), _pair_words, least)


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(1000000 * a * a / (left * right))``, exact for counts below 10^15."""
    wide = [x.cast("decimal(15,0)") for x in (a, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)"), wide[1] * wide[2])


def collocations(docs: DataFrame, least: int = MIN_COUNT, covered: int = COVERED_PERCENT, top: int | None = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases of two and three words.

    Null texts are empty, a null language is ``und`` (with texts that say so).  Repeated rows count each
    time; ties go to more occurrences, then to the smaller phrase in byte order.  Other columns are not read; an
    empty table gives an empty one.  Nothing is broadcast or collected but the number of pages.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), text_or_empty().alias("text"))
    pages = stage(rows.mapInArrow(_pager, _PAGES), "pages")
    each = pages.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x"))
    words = stage(each.groupBy("lang", F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("n")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = with_rank(words.filter(F.col("n") >= least), ["lang"], [F.col("n").desc(), "word"], "id")
    frequent = stage(ranked.withColumn("id", F.col("id") - 1), "words")

    asked = pages.select("page", "lang", F.posexplode("words").alias("at", "word")).join(frequent, ["lang", "word"])
    coded_pages = _beside(asked.select("page", "at", "id"), pages.select("page", "lang", "codes", F.size("words").alias("size")))
    streams = stage(coded_pages.mapInArrow(_streams, "page long, lang string, ids binary"), "streams")

    pairs = frequent_pairs(streams, least)
    triples = stage(frequent_triples(streams, pairs, least), "triples")

    def word(name: str) -> DataFrame:
        return frequent.select("lang", F.col("id").alias(name), F.col("word").alias(f"{name}_word"), F.col("n").alias(f"{name}_n"))

    two = pairs.select("lang", F.col("left").alias("w1"), F.col("right").alias("w2"), F.col("n").alias("a"), "id")
    three = (
        triples.select("lang", F.col("left").alias("id"), F.col("right").alias("w3"), F.col("n").alias("a"))
        .join(two.select("lang", "id", "w1", "w2", F.col("a").alias("n12")), ["lang", "id"])
        .join(two.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("n23")), ["lang", "w2", "w3"])
    )
    three = stage(three.drop("id"), "triples")
    around = three.select("lang", "w1", "w2", "a").union(three.select("lang", "w2", "w3", "a"))
    longest = around.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    kept = two.drop("id").join(longest, ["lang", "w1", "w2"], "left")
    kept = kept.filter(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))

    pair_rows = kept.join(word("w1"), ["lang", "w1"]).join(word("w2"), ["lang", "w2"]).select(
        "lang", F.concat_ws(" ", "w1_word", "w2_word").alias("phrase"), "a", F.col("w1_n").alias("l"), F.col("w2_n").alias("r")
    )
    named = three.join(word("w1"), ["lang", "w1"]).join(word("w2"), ["lang", "w2"]).join(word("w3"), ["lang", "w3"])
    first, second = _score(F.col("a"), F.col("w1_n"), F.col("n23")), _score(F.col("a"), F.col("n12"), F.col("w3_n"))
    triple_rows = named.select(
        "lang",
        F.concat_ws(" ", "w1_word", "w2_word", "w3_word").alias("phrase"),
        "a",
        F.when(first <= second, F.col("w1_n")).otherwise(F.col("n12")).alias("l"),
        F.when(first <= second, F.col("n23")).otherwise(F.col("w3_n")).alias("r"),
    )
    scored = pair_rows.union(triple_rows).withColumn("score", _score(F.col("a"), F.col("l"), F.col("r"))).join(F.broadcast(totals), "lang")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    if top is None:
        ranks = with_rank(scored, ["lang"], order).withColumn("rank", F.col("rank").cast("long"))
    else:
        ranks = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranks.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_direct_address_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


_SQL = r"""
WITH pieces AS (
  SELECT doc, lang, unnest(cut) AS piece, generate_subscripts(cut, 1) AS nth FROM (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
           string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[.,;:!?
-
]') AS cut
    FROM documents)),
listed AS (SELECT doc, lang, nth, regexp_extract_all(piece, '[^ 	]+') AS ws FROM pieces),
words AS (SELECT doc, lang, nth, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM listed),
beside AS (
  SELECT lang, w AS w1, lead(w) OVER ahead AS w2, lead(w, 2) OVER ahead AS w3
  FROM words WINDOW ahead AS (PARTITION BY doc, nth ORDER BY pos)),
one AS (SELECT lang, w1, count(*) AS f FROM beside GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang),
two AS (SELECT lang, w1, w2, count(*) AS f FROM beside WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, w1, w2, w3, count(*) AS f FROM beside WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, w1, w2, max(f) AS f FROM (
    SELECT lang, w1, w2, f FROM three UNION ALL SELECT lang, w2, w3, f FROM three) GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM two t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
  LEFT JOIN longer g ON g.lang = t.lang AND g.w1 = t.w1 AND g.w2 = t.w2
  WHERE g.f IS NULL OR 100 * g.f < 50 * t.f
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
  FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
  FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (
  SELECT lang, phrase, a, k, l, r, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op11_direct_address_tiles": op11_direct_address_tiles}
ORACLES: dict[str, str] = {"op11_direct_address_tiles": _SQL}
