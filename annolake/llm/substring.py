"""Removal of word windows that already occur in an earlier document.

Every window of ``WINDOW`` words gets a Rabin-Karp hash.  Hashes are dealt out by their window's
anchor, so that a bucket holds runs of neighbouring windows; in a bucket they are sorted and counted,
and a window whose hash also has a smaller document id is repeated.  Windows are counted per bucket
first, and a bucket with very many of them is split by window hash.  Repeated windows go back
to their document as intervals, which merge into maximal removal intervals.

Hashes travel packed (8 bytes a window and ``lanes``, plus a few per run) instead of as rows.  With one
lane two different windows among n meet by chance with probability n^2 / 2^65; ``lanes=2``
makes that n^2 / 2^129 for twice the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.llm.common import table, text_key, text_or_empty
from annolake.llm.windows import Rolling, merged, mix, new_values, page_slices, run_bounds, sliding_min

WINDOW = 50
GRAM = 10
PAGE_BYTES = 4 << 20
#: Buckets for each shuffle partition.
SPREAD = 8
#: Windows that one bucket may hold; a bucket with more is split by the hash of the whole window.
LIMIT = 2_000_000
#: Stands for a null document id, which so comes after all others.
LAST_ID = 2**63 - 1

#: Rows of hashes, or (``runs`` null) intervals already settled within a page, four longs each in ``docs``.
PACKED = "bucket int, docs binary, runs binary, hashes binary"
SPANS = "id long, key long, start int, stop int"


def _packed(rows: dict[str, list]) -> pa.RecordBatch:
    types = {"bucket": pa.int32(), "docs": pa.binary(), "runs": pa.binary(), "hashes": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in types.items()], list(types))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``(all words, bounds)``; words of text ``i`` lie from ``bounds[i]`` to ``bounds[i + 1]``."""
    cut = pc.ascii_split_whitespace(texts)
    words, offsets = cut.flatten(), cut.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    real = pc.not_equal(pc.binary_length(words), 0)
    upto = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), upto[offsets].astype(np.int64)


def word_values(words: pa.Array, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; different words are hashed once."""
    import xxhash

    coded = words.dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    values = np.fromiter((digest(w, lane) for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return values[coded.indices.to_numpy()]


def _repeated(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """True for windows whose hash (a row of lanes) also occurs with a smaller id."""
    order = np.lexsort(hashes.T[::-1]) if hashes.shape[1] > 1 else np.argsort(hashes[:, 0], kind="stable")
    ranked, ranked_ids = hashes[order], ids[order]
    starts, lengths = run_bounds(new_values(*ranked.T))
    out = np.zeros(len(ids), bool)
    if len(starts):
        least = np.minimum.reduceat(ranked_ids, starts)
        out[order] = ranked_ids > np.repeat(least, lengths)
    return out


def _spans(docs: np.ndarray, places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(doc, start, stop)`` of the words that windows at ``places`` cover, neighbours joined."""
    breaks = new_values(docs, places - np.arange(len(places)))
    starts, lengths = run_bounds(breaks)
    return docs[starts], places[starts], places[starts] + lengths - 1 + window


def split_table(sizes: dict[int, int], buckets: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """``(first part, parts)`` of every bucket: one of more than ``limit`` rows has parts numbered from ``buckets`` on."""
    first, parts, free = np.arange(buckets), np.ones(buckets, np.int64), buckets
    for bucket in sorted(b for b, size in sizes.items() if size > limit):
        first[bucket], parts[bucket] = free, -(-sizes[bucket] // limit)
        free += int(parts[bucket])
    return first, parts


def dealt_to(anchor_bucket: np.ndarray, hashes: np.ndarray, split: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The part of each row's bucket that its hash falls into: equal hashes of one bucket still meet."""
    first, parts = (x[anchor_bucket] for x in split)
    return (first + (mix(hashes) % parts.astype(np.uint64)).astype(np.int64)).astype(np.int32)


def _pages(window: int, gram: int, buckets: int, lanes: int, split: tuple[np.ndarray, np.ndarray] | None = None) -> Callable:
    """Packed rows of the pages; without ``split`` only the number of windows of each bucket."""

    def page(ids: np.ndarray, keys: np.ndarray, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        words, bounds = split_words(texts)
        if len(words) < window:
            return
        rolls = [Rolling(word_values(words, lane)) for lane in range(lanes)]
        doc_of = np.repeat(np.arange(len(ids)), np.diff(bounds))
        place = np.arange(len(words)) - bounds[:-1][doc_of]
        left = np.diff(bounds)[doc_of] - place
        at = np.flatnonzero(left >= window)
        if not len(at):
            return
        hashes = np.stack([r.all(window)[at] for r in rolls], axis=1)
        anchors = mix(sliding_min(rolls[0].all(gram), window - gram + 1)[at])
        bucket = (anchors % np.uint64(buckets)).astype(np.int32)
        docs, places = doc_of[at], place[at]

        known = _repeated(hashes, ids[docs])  # repeated within the page: settled here, not sent
        if split is None:
            numbers, sizes = np.unique(bucket[~known], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(sizes.astype(np.int64))], ["bucket", "n"])
            return
        bucket = dealt_to(bucket, hashes[:, 0], split)
        if known.any():
            doc, start, stop = _spans(docs[known], places[known], window)
            settled = np.stack([ids[doc], keys[doc], start, stop], axis=1).astype(np.int64).tobytes()
            yield _packed({"bucket": [int(bucket[0])], "docs": [settled], "runs": [None], "hashes": [None]})
        hashes, bucket, docs, places = hashes[~known], bucket[~known], docs[~known], places[~known]

        starts, lengths = run_bounds(new_values(bucket, docs, places - np.arange(len(places))))
        order = np.argsort(bucket[starts], kind="stable")
        run_bucket = bucket[starts][order]
        moved = np.repeat(starts[order], lengths[order])
        ends = np.cumsum(lengths[order])
        inner = np.arange(len(places)) - np.repeat(ends - lengths[order], lengths[order])
        sent = hashes[moved + inner]
        groups, sizes = run_bounds(new_values(run_bucket))
        rows: dict[str, list] = {"bucket": [], "docs": [], "runs": [], "hashes": []}
        for first, count in zip(groups.tolist(), sizes.tolist(), strict=True):
            these = order[first : first + count]
            doc, local = np.unique(docs[starts[these]], return_inverse=True)
            rows["bucket"].append(int(run_bucket[first]))
            rows["docs"].append(np.stack([ids[doc], keys[doc]], axis=1).tobytes())
            runs = np.stack([local, places[starts[these]], lengths[these]])
            rows["runs"].append(runs.astype(np.int32).tobytes())
            low = int(ends[first] - lengths[these[0]])
            rows["hashes"].append(sent[low : int(ends[first + count - 1])].tobytes())
        if rows["bucket"]:
            yield _packed(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            texts = batch.column("text")
            for start, stop in page_slices(texts, PAGE_BYTES):
                yield from page(ids[start:stop], keys[start:stop], texts.slice(start, stop - start))

    return run


def by_bucket(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[tuple]]:
    """Rows of each bucket of a partition that is sorted by ``bucket``."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ["bucket", *columns]), strict=True):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _span_batch(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(ids), pa.array(keys), pa.array(starts.astype(np.int32)), pa.array(stops.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, ["id", "key", "start", "stop"])


def _counter(window: int, lanes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_bucket(batches, ["docs", "runs", "hashes"]):
            settled = [np.frombuffer(d, np.int64).reshape(-1, 4) for _, d, packed, _ in rows if packed is None]
            for spans in settled:
                yield _span_batch(*spans.T)
            rows = [row for row in rows if row[2] is not None]
            if not rows:
                continue
            docs, runs, base = [], [], 0
            for _, known, packed, _ in rows:
                docs.append(np.frombuffer(known, np.int64).reshape(-1, 2))
                part = np.frombuffer(packed, np.int32).reshape(3, -1).astype(np.int64)
                runs.append(part + np.array([[base], [0], [0]]))
                base += len(docs[-1])
            hashes = np.concatenate([np.frombuffer(h, np.uint64) for *_, h in rows]).reshape(-1, lanes)
            known, (doc, start, length) = np.concatenate(docs), np.concatenate(runs, axis=1)
            doc_of = np.repeat(doc, length)
            place = np.arange(len(hashes)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)
            again = _repeated(hashes, known[doc_of, 0])
            if again.any():
                doc, first, last = _spans(doc_of[again], place[again], window)
                yield _span_batch(known[doc, 0], known[doc, 1], first, last)

    return run


def keyed_documents(docs: DataFrame) -> DataFrame:
    """``id`` (null as LAST_ID), ``key`` (the text's hash) and ``text`` (null as empty)."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"), text_key().alias("key"), text_or_empty().alias("text")
    )


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, lanes: int = 1) -> DataFrame:
    """``id, key, start, stop``: word intervals that repeated windows cover (not yet merged)."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions * SPREAD
    texts = keyed_documents(docs)
    counted = texts.mapInArrow(_pages(window, gram, buckets, lanes), "bucket int, n long").groupBy("bucket").agg(F.sum("n"))
    split = split_table(dict(map(tuple, counted.collect())), buckets, LIMIT)
    packed = texts.mapInArrow(_pages(window, gram, buckets, lanes, split), PACKED)
    dealt = packed.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_counter(window, lanes), SPANS)


_CLEAN = "id long, key long, n_words long, n_removed long, spans array<struct<start:int,stop:int>>, kept string"


def _cleaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        rows = []
        names = ["id", "key", "text", "spans"]
        for doc_id, key, text, spans in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            words = text.encode("utf-8", "surrogatepass").split()
            found = np.array([(s["start"], s["stop"]) for s in spans or []], np.int64).reshape(-1, 2)
            starts, stops = merged(found[:, 0], found[:, 1])
            kept, at = [], 0
            for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
                kept += words[at:start]
                at = stop
            kept += words[at:]
            ranges = [{"start": s, "stop": e} for s, e in zip(starts.tolist(), stops.tolist(), strict=True)]
            rows.append((doc_id, key, len(words), int((stops - starts).sum()), ranges, b" ".join(kept).decode("utf-8", "surrogatepass")))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), kind, pa.string()]
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["id", "key", "n_words", "n_removed", "spans", "kept"]
        )


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Documents beside the list of their spans; a list is at most as long as its text."""
    listed = spans.groupBy("id", "key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return keyed_documents(docs).join(listed, ["id", "key"], "left").select("id", "key", "text", "spans")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, lanes: int = 1) -> DataFrame:
    """``doc_id, n_words, n_removed, spans`` (maximal word intervals) and ``kept`` text per row of ``docs``.

    Removed are words covered by a window of ``window`` words that also starts in a document with a
    smaller id; windows are judged on the input.  A null text has no words.  A null id
    counts as larger than all others.  Rows of one id never remove each other's words.  Other
    columns are not read; an empty table gives an empty one.  Passages that very many documents share are
    reduced to one document per page of text before the shuffle.
    """
    if not 0 < gram <= window:
        raise ValueError("the gram has to fit into the window")
    spans = repeated_windows(docs, window, gram, lanes)
    cleaned = with_spans(docs, spans).mapInArrow(_cleaner, _CLEAN)
    doc_id = F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id")
    return cleaned.select(doc_id, "n_words", "n_removed", "spans", "kept")


def op5_rabin_karp_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op5_rabin_karp_windows": op5_rabin_karp_windows}
ORACLES: dict[str, str] = {}
