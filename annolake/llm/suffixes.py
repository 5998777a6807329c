"""Removal of byte strings that already start earlier, by suffix arrays.

Every start of a ``LENGTH``-byte string belongs to the anchor of that string, the smallest hash of the
short grams inside it; a run of starts with one anchor is a fragment.  Equal strings have
equal anchors, so only fragments of one anchor can hold equal strings:

1. fragments are grouped by anchor and content.  Of equal fragments only the earliest is kept on,
   all starts of the others are repeated;
2. anchors with two or more different fragments fetch their bytes, and a suffix array of each such
   group brings equal strings together; in a group of very many fragments the 128-bit hashes of the
   whole strings are counted instead, so that no task has to hold the group;
3. the covered bytes return to their documents and merge into maximal removed runs.

The suffix array is built by linear grouping: suffixes are grouped by their longest Lyndon prefix,
in descending order of the groups, each group moving the previous smaller suffixes of its members to
groups of their own; then one pass over the finished groups emits the order along the same pointers.
Nothing is renamed and nothing recurses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.llm.common import stage, table
from annolake.llm.substring import LAST_ID, by_bucket, dealt_to, keyed_documents, split_table, with_spans
from annolake.llm.windows import Rolling, merged, mix, new_values, page_slices, run_bounds, sliding_min

LENGTH = 100
GRAM = 50
#: Bytes of text handled at once; a longer text goes in overlapping sections.
PAGE_BYTES = 1 << 20
SPREAD = 8
#: Different fragments of one anchor that a suffix array takes together; strings of larger groups meet by hash.
GROUP = 256
#: Fragments that one bucket may hold; a bucket with more is split by content, and its anchors count as large groups.
LIMIT = 500_000

_FOUND = "id long, key long, start int, stop int, anchor long, n int"


def suffix_array(text: bytes) -> list[int]:
    """The starts of all suffixes of ``text`` in lexicographic order (a prefix before what extends it)."""
    size = len(text) + 1  # the last suffix is empty and the smallest
    values = [byte + 1 for byte in text] + [0]
    begins = [0] * 258
    for value in values:
        begins[value + 1] += 1
    for value in range(257):
        begins[value + 1] += begins[value]
    count = {begins[v]: begins[v + 1] - begins[v] for v in range(257) if begins[v + 1] > begins[v]}
    group = [begins[value] for value in values]  # a group's name is its first place
    free, order, place = begins[:], [0] * size, [0] * size
    for suffix, value in enumerate(values):
        order[free[value]], place[suffix] = suffix, free[value]
        free[value] += 1

    smaller = [-1] * size  # the last earlier suffix of a lower group
    end = size
    while end:
        first = group[order[end - 1]]
        pointed: dict[int, int] = {}
        for suffix in sorted(order[first:end]):
            back = suffix - 1
            while back >= 0 and group[back] >= first:
                back = smaller[back]
            smaller[suffix] = back
            if back >= 0:
                pointed[back] = pointed.get(back, 0) + 1
        # Suffixes that more members point to are larger: they leave first, each time to the end of their group.
        by_count: dict[int, dict[int, list[int]]] = {}
        for suffix, times in pointed.items():
            by_count.setdefault(times, {}).setdefault(group[suffix], []).append(suffix)
        for times in sorted(by_count, reverse=True):
            for old, leaving in by_count[times].items():
                held = count[old]
                new = old + held - len(leaving)
                if new == old:
                    continue
                count[old], count[new] = held - len(leaving), len(leaving)
                at = old + held
                for suffix in leaving:
                    at -= 1
                    here, other = place[suffix], order[at]
                    order[here], place[other] = other, here
                    order[at], place[suffix] = suffix, at
                    group[suffix] = new
        end = first

    done, following = [False] * size, dict.fromkeys(count, 0)
    out = [0] * size
    out[0] = size - 1
    done[size - 1] = True
    for at in range(size):
        suffix = out[at] - 1
        while suffix >= 0 and not done[suffix]:
            own = group[suffix]
            out[own + following[own]] = suffix
            following[own] += 1
            done[suffix] = True
            suffix = smaller[suffix]
    return out[1:]


def repeated_starts(fragments: list[tuple[int, int, bytes]], length: int) -> list[tuple[int, int]]:
    """``(fragment, offset)`` of strings of ``length`` bytes that start earlier in another or the same fragment.

    A fragment is ``(document, start, bytes)``; earlier means smaller by these two.
    """
    text = b"".join(data for *_, data in fragments)
    owner, offset = [], []
    for number, (*_, data) in enumerate(fragments):
        valid = max(0, len(data) - length + 1)
        owner += [number] * valid + [-1] * (len(data) - valid)
        offset += range(len(data))
    found, group, before = [], [], None

    def close() -> None:
        if len(group) > 1:
            keyed = [((fragments[owner[s]][0], fragments[owner[s]][1] + offset[s]), s) for s in group]
            least = min(k for k, _ in keyed)
            found.extend((owner[s], offset[s]) for k, s in keyed if k > least)

    for start in suffix_array(text):
        if owner[start] < 0:
            continue
        string = text[start : start + length]
        if string != before:
            close()
            group, before = [], string
        group.append(start)
    close()
    return found


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64))


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, bounds)`` of the texts of a string array."""
    buffers = texts.buffers()
    bounds = np.frombuffer(buffers[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[bounds[0] : bounds[-1]] if buffers[2] else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def _page_fragments(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Per fragment: text, start, number of starts, anchor hash, content hash."""
    sizes = np.diff(bounds)
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    roll = Rolling(_byte_values()[data])
    grams = roll.all(gram)
    low = np.uint64(0xFFFFFFFF)
    ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)  # ties go to the first
    least = (sliding_min(ranked, length - gram + 1) & low).astype(np.int64)
    doc_of = np.repeat(np.arange(len(sizes)), sizes)
    valid = np.flatnonzero(bounds[1:][doc_of] - np.arange(len(data)) >= length)
    anchors, docs = least[valid], doc_of[valid]
    starts, counts = run_bounds(new_values(anchors, docs))
    first = valid[starts]
    content = roll.spans(first, first + counts + length - 1) ^ mix((first - anchors[starts]).astype(np.uint64))
    return docs[starts], first - bounds[docs[starts]], counts, grams[anchors[starts]], mix(content)


def _order(ids: np.ndarray, starts: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    return np.lexsort((starts, ids, *reversed(keys)))


PACKED = "bucket int, docs binary, runs binary, hashes binary"


def _packed(rows: dict[str, list]) -> pa.RecordBatch:
    types = {"bucket": pa.int32(), "docs": pa.binary(), "runs": pa.binary(), "hashes": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in types.items()], list(types))


def _pages(length: int, gram: int, buckets: int, split: tuple[np.ndarray, np.ndarray] | None = None) -> Callable:
    """Packed rows of the pages; without ``split`` only the number of fragments of each bucket."""

    def page(ids: np.ndarray, keys: np.ndarray, data: np.ndarray, bounds: np.ndarray, skipped: int) -> Iterator[pa.RecordBatch]:
        docs, starts, counts, anchors, content = _page_fragments(data, bounds, length, gram)
        if not len(docs):
            return
        starts = starts + skipped
        order = _order(ids[docs], starts, anchors, content)
        again = np.zeros(len(docs), bool)
        # Equal fragments after the first of the page are settled here (but for a repeated first place).
        head = new_values(anchors[order], content[order])
        at, size = run_bounds(head)
        lead = np.repeat(order[at], size)
        again[order] = (ids[docs[order]] != ids[docs[lead]]) | (starts[order] != starts[lead])
        rows: dict[str, list] = {"bucket": [], "docs": [], "runs": [], "hashes": []}
        if split is None:
            numbers, sizes = np.unique((mix(anchors[~again]) % np.uint64(buckets)).astype(np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(sizes.astype(np.int64))], ["bucket", "n"])
            return
        if again.any():
            d = docs[again]
            stops = starts[again] + counts[again] + length - 1
            settled = np.stack([ids[d], keys[d], starts[again], stops], axis=1).astype(np.int64)
            for piece in np.array_split(settled, -(-len(settled) // 20_000)):
                rows["bucket"].append(int(np.uint64(piece[0, 1] & (2**62)) % buckets))
                rows["docs"].append(piece.tobytes())
                rows["runs"].append(None)
                rows["hashes"].append(None)
        docs, starts, counts, anchors, content = (x[~again] for x in (docs, starts, counts, anchors, content))
        bucket = dealt_to((mix(anchors) % np.uint64(buckets)).astype(np.int32), content, split)
        order = np.argsort(bucket, kind="stable")
        groups, sizes = run_bounds(new_values(bucket[order]))
        for first, count in zip(groups.tolist(), sizes.tolist(), strict=True):
            these = order[first : first + count]
            doc, local = np.unique(docs[these], return_inverse=True)
            rows["bucket"].append(int(bucket[these[0]]))
            rows["docs"].append(np.stack([ids[doc], keys[doc]], axis=1).tobytes())
            rows["runs"].append(np.stack([local, starts[these], counts[these]]).astype(np.int32).tobytes())
            rows["hashes"].append(np.stack([anchors[these], content[these]]).tobytes())
        yield _packed(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            texts = batch.column("text")
            for start, stop in page_slices(texts, PAGE_BYTES):
                data, bounds = _raw(texts.slice(start, stop - start))
                for at in range(0, max(len(data), 1), PAGE_BYTES):  # more than one for a single long text only
                    part = data[at : at + PAGE_BYTES + length - 1]
                    ends = bounds if len(part) == len(data) else np.array([0, len(part)])
                    yield from page(ids[start:stop], keys[start:stop], part, ends, at)
                    if len(part) == len(data):
                        break

    return run


def _found(ids, keys, starts, stops, anchors=None, counts=None) -> pa.RecordBatch:
    size = len(ids)
    arrays = [
        pa.array(ids), pa.array(keys), pa.array(starts.astype(np.int32)), pa.array(stops.astype(np.int32)),
        pa.nulls(size, pa.int64()) if anchors is None else pa.array(anchors.view(np.int64)),
        pa.nulls(size, pa.int32()) if counts is None else pa.array(counts.astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["id", "key", "start", "stop", "anchor", "n"])


def _grouper(length: int, buckets: int, group: int) -> Callable:
    """Repeated fragments (anchor null) and fragments that need a comparison (anchor set).

    Buckets from ``buckets`` on are parts of larger ones: an anchor may have more fragments in the other parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_bucket(batches, ["docs", "runs", "hashes"]):
            for _, settled, packed, _ in rows:
                if packed is None:
                    yield _found(*np.frombuffer(settled, np.int64).reshape(-1, 4).T)
            rows = [row for row in rows if row[2] is not None]
            if not rows:
                continue
            known, runs, hashes, base = [], [], [], 0
            for _, docs, packed, pair in rows:
                known.append(np.frombuffer(docs, np.int64).reshape(-1, 2))
                part = np.frombuffer(packed, np.int32).reshape(3, -1).astype(np.int64)
                runs.append(part + np.array([[base], [0], [0]]))
                hashes.append(np.frombuffer(pair, np.uint64).reshape(2, -1))
                base += len(known[-1])
            docs = np.concatenate(known)
            (doc, starts, counts), (anchors, content) = np.concatenate(runs, axis=1), np.concatenate(hashes, axis=1)
            ids, keys = docs[doc].T
            order = _order(ids, starts, anchors, content)
            ids, keys, starts, counts, anchors, content = (x[order] for x in (ids, keys, starts, counts, anchors, content))
            stops = starts + counts + length - 1
            at, size = run_bounds(new_values(anchors, content))
            lead = np.repeat(at, size)
            again = (ids != ids[lead]) | (starts != starts[lead])
            if again.any():
                yield _found(ids[again], keys[again], starts[again], stops[again])
            first, kinds = run_bounds(new_values(anchors[at]))
            kinds = np.repeat(kinds, kinds)
            if rows[0][0] >= buckets:
                kinds = np.maximum(kinds, group + 1)
            ask = at[kinds > 1]
            if len(ask):
                yield _found(ids[ask], keys[ask], starts[ask], stops[ask], anchors[ask], kinds[kinds > 1])

    return run


_FRAGMENT = "block long, id long, key long, start int, data binary"


def _fetcher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the fragments asked for."""
    names = ["block", "id", "key", "start", "data"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("id", "key", "text", "asked")]
        for doc_id, key, text, asked in zip(*columns, strict=True):
            data = text.encode("utf-8", "surrogatepass")
            rows += [(ask["anchor"], doc_id, key, ask["start"], data[ask["start"] : ask["stop"]]) for ask in asked]
            if len(rows) > 20_000:
                yield out(rows)
                rows = []
        if rows:
            yield out(rows)


_STRINGS = "id long, key long, start int, stop int, one long, two long"


def _hasher(length: int) -> Callable:
    """Two hashes of every string of the fragments asked for (``one``, ``two``), or (both null) intervals
    settled within about a page: strings that start earlier in it."""
    names = ["id", "key", "start", "stop", "one", "two"]

    def out(spans: tuple[np.ndarray, ...], hashes: tuple[np.ndarray, ...] | None) -> pa.RecordBatch:
        ids, keys, starts, stops = spans
        arrays = [pa.array(ids), pa.array(keys), pa.array(starts.astype(np.int32)), pa.array(stops.astype(np.int32))]
        pair = [pa.nulls(len(ids), pa.int64())] * 2 if hashes is None else [pa.array(h.view(np.int64)) for h in hashes]
        return pa.RecordBatch.from_arrays([*arrays, *pair], names)

    def page(pieces: list[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
        sizes = np.array([len(p[3]) for p in pieces])
        ends = np.cumsum(sizes)
        ids, keys, begins = (np.array(c, np.int64) for c in list(zip(*pieces, strict=True))[:3])
        values = _byte_values()
        one, two = (Rolling(v[data]).all(length) for v in (values, mix(values ^ np.uint64(0x5851F42D4C957F2D))))
        own = np.repeat(np.arange(len(sizes)), sizes)
        at = np.flatnonzero(ends[own] - np.arange(len(data)) >= length)
        own = own[at]
        ids, keys, starts = ids[own], keys[own], begins[own] + at - (ends - sizes)[own]
        one, two = one[at], two[at]
        order = _order(ids, starts, one, two)
        ids, keys, starts, one, two = (x[order] for x in (ids, keys, starts, one, two))
        first, count = run_bounds(new_values(one, two))
        lead = np.repeat(first, count)
        again = (ids != ids[lead]) | (starts != starts[lead])
        if again.any():
            spans = ids[again], keys[again], starts[again]
            order = np.lexsort(spans[::-1])
            i, k, s = (x[order] for x in spans)
            begin, count = run_bounds(new_values(i, k, s - np.arange(len(s))))
            yield out((i[begin], k[begin], s[begin], s[begin + count - 1] + length), None)
        kept = ~again
        yield out((ids[kept], keys[kept], starts[kept], starts[kept] + length), (one[kept], two[kept]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, held = [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("id", "key", "text", "asked")]
            for doc_id, key, text, asked in zip(*columns, strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for ask in asked:
                    pieces.append((doc_id, key, ask["start"], data[ask["start"] : ask["stop"]]))
                    held += ask["stop"] - ask["start"]
                    if held >= PAGE_BYTES:
                        yield from page(pieces)
                        pieces, held = [], 0
        if pieces:
            yield from page(pieces)

    return run


def _sorter(length: int) -> Callable:
    def spans(group: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        found: dict[int, list[int]] = {}
        for number, offset in repeated_starts([(i, s, d) for _, i, _, s, d in group], length):
            found.setdefault(number, []).append(offset)
        for number, offsets in found.items():
            _, doc_id, key, start, _ = group[number]
            starts = np.sort(np.array(offsets)) + start
            for first, last in zip(*merged(starts, starts + length), strict=True):
                yield doc_id, key, int(first), int(last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        renamed = (b.rename_columns(["bucket", *b.schema.names[1:]]) for b in batches)
        for rows in by_bucket(renamed, ["id", "key", "start", "data"]):
            if out := list(spans(rows)):
                arrays = np.array(out, np.int64).T
                yield _found(*arrays).select(["id", "key", "start", "stop"])

    return run


def repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``id, key, start, stop``: byte intervals that repeated strings cover (not yet merged)."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = partitions * SPREAD
    documents = keyed_documents(docs)
    counted = documents.mapInArrow(_pages(length, gram, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n"))
    split = split_table(dict(map(tuple, counted.collect())), buckets, LIMIT)
    packed = documents.mapInArrow(_pages(length, gram, buckets, split), PACKED)
    dealt = packed.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    found = stage(dealt.mapInArrow(_grouper(length, buckets, GROUP), _FOUND), "fragments")

    def asking(fragments: DataFrame) -> DataFrame:
        asked = fragments.groupBy("id", "key").agg(F.collect_list(F.struct("start", "stop", "anchor")).alias("asked"))
        # Rows that repeat a document's id and text ask once.
        return documents.join(asked, ["id", "key"]).select("id", "key", "text", "asked")

    spans = ["id", "key", "start", "stop"]
    fragments = asking(found.filter(F.col("anchor").isNotNull() & (F.col("n") <= GROUP))).mapInArrow(_fetcher, _FRAGMENT)
    blocks = fragments.repartition("block").sortWithinPartitions("block", "id", "start")
    sorted_ = blocks.mapInArrow(_sorter(length), "id long, key long, start int, stop int")
    small = found.filter(F.col("anchor").isNull()).select(*spans).union(sorted_)
    large = found.filter(F.col("n") > GROUP)
    if large.isEmpty():
        return small
    strings = stage(asking(large).mapInArrow(_hasher(length), _STRINGS), "strings")
    place = F.struct("id", "start")
    known = strings.filter("one is not null")
    least = known.groupBy("one", "two").agg(F.min(place).alias("least"), F.count("*").alias("times"))
    again = known.join(least.filter("times > 1").drop("times"), ["one", "two"]).filter(place > F.col("least"))
    return small.union(strings.filter("one is null").select(*spans)).union(again.select(*spans))


_CLEAN = "id long, key long, n_bytes long, n_removed long, spans array<struct<start:int,stop:int>>, kept binary"


def _cleaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), kind, pa.binary()]
    names = ["id", "key", "n_bytes", "n_removed", "spans", "kept"]
    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("id", "key", "text", "spans")]
        for doc_id, key, text, spans in zip(*columns, strict=True):
            data = text.encode("utf-8", "surrogatepass")
            found = np.array([(s["start"], s["stop"]) for s in spans or []], np.int64).reshape(-1, 2)
            starts, stops = merged(found[:, 0], found[:, 1])
            kept, at = [], 0
            for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
                kept.append(data[at:start])
                at = stop
            kept.append(data[at:])
            ranges = [{"start": s, "stop": e} for s, e in zip(starts.tolist(), stops.tolist(), strict=True)]
            rows.append((doc_id, key, len(data), int((stops - starts).sum()), ranges, b"".join(kept)))
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def remove_repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans`` (maximal removed byte runs) and ``kept`` bytes per row of ``docs``.

    Removed are the bytes covered by a string of ``length`` bytes that also starts earlier: in a document
    with a smaller id or earlier in the same one; overlaps count, and strings are judged on the
    input.  A null text is empty; a null id counts as larger than all others.  Rows of one id are
    one document for "earlier": only another start in them can be earlier, and repeated rows get
    the same result.  Other columns are not read; an empty table gives an empty one.
    """
    if not 0 < gram <= length:
        raise ValueError("the gram has to fit into the string")
    cleaned = with_spans(docs, repeated_strings(docs, length, gram)).mapInArrow(_cleaner, _CLEAN)
    doc_id = F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id")
    return cleaned.select(doc_id, "n_bytes", "n_removed", "spans", "kept")


def op6_suffix_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_strings(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op6_suffix_grouping": op6_suffix_grouping}
ORACLES: dict[str, str] = {}
