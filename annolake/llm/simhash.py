"""SimHash near-duplicates found through Golay-code fuzzy hashing.

The binary (23, 12) Golay code is perfect: every 23-bit word lies within 3 bits of exactly one
codeword.  A word's keys are the indices of all codewords within 4 bits of it (one, or six when
the nearest is 3 bits away).  Two words within 2 bits share a key; for words within 1 bit, the
nearest index of either is among the keys of the other.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits.  Of at most 4 differing bits, by
the pigeonhole principle, either

* one segment is free of errors and another has at most 2: keys (exact segment, Golay key of the
  other), 6 pairs of segments, or
* two segments have exactly one error each: keys (nearest index of one, Golay key of the other)
  and the reverse, 3 pairs of segments.

Rows that share a key are compared bit by bit, so no pair within the radius is lost and no other one
is linked.  Only a spanning forest of each key's rows is emitted, never all pairs, and a key with
very many rows is cut into blocks that meet two at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolake.llm.common import forget_shuffles, release, stage, table, text_or_empty
from annolake.llm.components import connected_components

SHINGLE = 4
RADIUS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of one key compared at once; larger keys are cut into blocks of this size.
BLOCK = 2048
#: Generator polynomial of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def _syndromes(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - 11))
    return rest


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """``(error by syndrome, key offsets by syndrome)``; offsets are XORed to the nearest index, -1 is none."""
    messages = np.arange(4096, dtype=np.int64) << 11
    codewords = messages | _syndromes(messages)
    singles = 1 << np.arange(23)
    errors = np.zeros(2048, np.int64)
    offsets = np.full((2048, 6), -1, np.int64)
    offsets[:, 0] = 0
    heavy = codewords[np.bitwise_count(codewords) == 7]
    for i in range(23):
        errors[_syndromes(singles[i : i + 1])] = singles[i]
        for j in range(i):
            pair = singles[i] | singles[j]
            errors[_syndromes(np.array([pair]))] = pair
            for k in range(j):
                triple = pair | singles[k]
                at = _syndromes(np.array([triple]))[0]
                errors[at] = triple
                offsets[at, 1:] = heavy[(heavy & triple) == triple] >> 11
    return errors, offsets


def golay_keys(words: np.ndarray, errors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Codeword indices near each word, nearest first; -1 fills up."""
    syndromes = _syndromes(words)
    nearest = (words.astype(np.int64) ^ errors[syndromes]) >> 11
    near = offsets[syndromes]
    return np.where(near >= 0, nearest[:, None] ^ near, -1)


def fingerprint_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` of all keys of the uint64 fingerprints."""
    errors, offsets = golay_tables()
    parts = [((prints >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.int64) for at, size in SEGMENTS]
    near = [golay_keys(p, errors, offsets) for p in parts]
    rows, keys, kind = [], [], 0
    every = np.arange(len(prints))

    def add(kind: int, base: np.ndarray, wide: np.ndarray) -> None:
        row, column = np.nonzero(wide >= 0)
        rows.append(every[row])
        keys.append((kind << 40) | (base[row] << 12) | wide[row, column])

    for exact in range(3):
        for other in range(3):
            if other != exact:
                add(kind, parts[exact], near[other])
                kind += 1
    for one in range(3):
        for two in range(one):
            add(kind, near[one][:, 0], near[two])
            # The reverse: same kind, so that both meet, with the nearest index of `two` in the low bits.
            row, column = np.nonzero(near[one] >= 0)
            rows.append(every[row])
            keys.append((kind << 40) | (near[one][row, column] << 12) | near[two][row, 0])
            kind += 1
    return np.concatenate(rows), np.concatenate(keys)


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``shingle`` words, A-Z in lower case; of all words if there are fewer."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    reach = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - reach].tolist(), ends[reach:].tolist(), strict=True)
    return np.array([digest(joined[s:e], 42) for s, e in spans], "<u8")


def majority(hashes: np.ndarray) -> int:
    """Each bit is 1 if it is set in over half the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        lanes = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(lanes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, A-Z in lower case; 0 without words."""
    return majority(shingle_hashes(text, shingle))


def _print_batches(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([simhash(t.as_py(), shingle) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values.view(np.int64))], [*batch.schema.names[:-1], "print"])

    return run


def fingerprints(docs: DataFrame, keys: list[str], shingle: int = SHINGLE) -> DataFrame:
    """``keys`` and ``print``, the SimHash of ``text`` as a signed long, for every row.

    A null text has no words; fingerprints of texts without words are 0.
    """
    rows = docs.select(*keys, text_or_empty().alias("text"))
    kept = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes[:-1])
    return rows.mapInArrow(_print_batches(shingle), f"{kept}, print long")


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False)
        rows, keys = fingerprint_keys(prints.view(np.uint64))
        for at in range(0, len(rows), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(keys[part]), pa.array(prints[rows[part]])], ["key", "node"])


def _apart(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints whose words lie along the last axis."""
    return np.bitwise_count(left ^ right).sum(axis=-1, dtype=np.int64)


def _forest(nodes: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links of up to ``radius`` bits connect among the rows."""
    nodes, first = np.unique(nodes, return_index=True)
    prints, labels = prints[first], np.arange(len(nodes))
    while True:
        lowest = labels.copy()
        for at in range(0, len(nodes), 256):
            close = _apart(prints[at : at + 256, None], prints[None, :]) <= radius
            lowest[at : at + 256] = np.where(close, labels[None, :], len(nodes)).min(axis=1)
        lowest = lowest[lowest]
        if (lowest == labels).all():
            moved = labels != np.arange(len(nodes))
            return nodes[moved], nodes[labels[moved]]
        labels = lowest


def _linker(radius: int) -> Callable:
    """Edges of each block; rows are ``block, node, print`` (binary, 8 bytes a word) in the order of blocks."""

    def link(groups: np.ndarray, nodes: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        sizes = np.diff(np.append(starts, len(groups)))
        small = np.repeat(sizes <= 8, sizes)
        for step in range(1, 8):  # small groups all at once, by the distance within the group
            both = np.flatnonzero(small[:-step] & (groups[step:] == groups[:-step]))
            close = both[_apart(prints[both + step], prints[both]) <= radius]
            yield nodes[close + step], nodes[close]
        for start, size in zip(starts[sizes > 8].tolist(), sizes[sizes > 8].tolist(), strict=True):
            yield _forest(nodes[start : start + size], prints[start : start + size], radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            for a, b in link(*rows):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            groups = batch.column("block").to_numpy(zero_copy_only=False)
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            prints = np.frombuffer(b"".join(batch.column("print").to_pylist()), "<u8").reshape(len(batch), -1)
            rows = [groups, nodes, prints]
            held = [np.concatenate(pair) for pair in zip(held, rows, strict=True)] if held else rows
            others = np.flatnonzero(held[0] != held[0][-1])
            cut = int(others[-1]) + 1 if len(others) else 0  # the last group may go on in the next batch
            if cut:
                yield from out([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held:
            yield from out(held)

    return run


def linked_prints(prints: DataFrame, keyed: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` between the nodes of ``prints`` (``node``, ``print`` binary) that share a key of ``keyed`` (``key,
    node``): they connect what links of up to ``radius`` bits within the keys connect."""
    within = Window.partitionBy("key")
    shared = keyed.select(
        "key",
        "node",
        F.count("*").over(within).alias("n"),
        (F.row_number().over(within.orderBy("node")) - 1).alias("place"),
    ).filter("n > 1")
    own = F.floor(F.col("place") / block)
    others = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / block))
    meetings = F.transform(others, lambda o: F.xxhash64("key", F.least(own, o), F.greatest(own, o)))
    spread = shared.select(F.explode(meetings).alias("block"), "node").join(prints, "node")
    ordered = spread.select("block", "node", "print").repartition("block").sortWithinPartitions("block")
    return ordered.mapInArrow(_linker(radius), "a long, b long").distinct()


def print_links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` between distinct 64-bit fingerprints (``print``): their components are those of all pairs that
    differ in at most ``radius`` (up to 4) bits."""
    if radius > RADIUS:
        raise ValueError("the keys find pairs of up to 4 differing bits")
    nodes = prints.select(F.col("print").alias("node"), F.unhex(F.lpad(F.hex("print"), 16, "0")).alias("print"))
    keyed = prints.select("print").mapInArrow(_key_batches, "key long, node long")
    return linked_prints(nodes, keyed, radius, block)


def near_duplicates(docs: DataFrame, keys: list[str], shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``keys`` (the first is the document id), ``print`` and ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id that links of up to ``radius`` bits reach, the row's own
    included; a null id is never the smallest (null only where all are).  Repeated rows and equal
    texts share a fingerprint and thus a component.  Other columns are not read; an empty table
    gives an empty one.  Comparison works on distinct fingerprints, so a group of copies is one.
    """
    rows = stage(fingerprints(docs, keys, shingle), "prints")
    distinct = stage(rows.groupBy("print").agg(F.min(keys[0]).alias("first")), "distinct-prints")
    roots = connected_components(print_links(distinct, radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("print", "component_id")
    return rows.join(classes, "print").select(*keys, "print", "component_id")


#: Near copies: words of a shingle, and the least Jaccard similarity.
COPY_SHINGLE = 5
SIMILARITY = 0.8
#: Counters of the shingle frequencies; they decide the order of shingles only, never the result.
COUNTERS = 1 << 18
#: Members that one task compares with a set.
MEMBERS = 20_000
#: Words of 64 bits in a set's sketch.
SKETCH_WORDS = 16
#: Most rounds of comparisons by shared shingles, in each a set with one other, before all pairs left are compared.
ROUNDS = 8


def shingle_set(text: str, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, shingle))


def _set_batches(shingle: int) -> Callable:
    """``node`` (hash of the set of shingles) and ``print`` of every row, and its text once for each task that
    meets the set: texts take far less room than their sets, which later steps make again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        seen: set[int] = set()
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                nodes, prints, texts = [], [], []
                for text in part.column("text").to_pylist():
                    hashes = shingle_hashes(text, shingle)
                    node = xxhash.xxh64_intdigest(np.unique(hashes).tobytes())
                    nodes.append(node)
                    prints.append(majority(hashes))
                    texts.append(None if node in seen else text)
                    seen.add(node)
                if len(seen) > 200_000:  # repeated texts are then sent again
                    seen.clear()
                made = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (nodes, prints)] + [pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], [*part.schema.names[:-1], "node", "print", "text"])

    return run


def _count_batches(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                # Shingles of one set may share a counter, so `add.at`.
                np.add.at(counts, shingle_set(text.as_py(), shingle) % np.uint64(COUNTERS), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["counter", "n"])

    return run


def _prefix_batches(counts: np.ndarray, shingle: int, similarity: float) -> Callable:
    """``key, node, size``: the rarest shingles of each set, as many as sets that alike cannot all differ in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = [], []
            for text in batch.column("text"):
                held = shingle_set(text.as_py(), shingle)
                rarest = np.lexsort((held, counts[held % np.uint64(COUNTERS)]))
                keys.append(held[rarest[: 0 if not len(held) else len(held) - int(np.ceil(similarity * len(held) - 1e-9)) + 1]])
                sizes.append(len(held))
            lengths = [len(k) for k in keys]
            nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), lengths)
            values = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            sizes = np.repeat(np.array(sizes, np.int32), lengths)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(nodes), pa.array(sizes)], ["key", "node", "size"])

    return run


def _verifier(shingle: int, similarity: float) -> Callable:
    """Pairs of a group's first set and its other sets that are alike enough; the first comes before the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, base = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = [], []
            columns = [batch.column(c).to_pylist() for c in ("a", "slot", "other", "node", "text")]
            for lead, slot, other, node, text in zip(*columns, strict=True):
                held = shingle_set(text, shingle)
                if not other:
                    first, base = (lead, slot), held
                    continue
                if (lead, slot) != first:
                    raise ValueError("a group without its first set")
                both = np.searchsorted(base, held)
                shared = int((base[np.minimum(both, len(base) - 1)] == held).sum()) if len(base) else 0
                if shared >= similarity * (len(base) + len(held) - shared) - 1e-9:
                    a.append(lead)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def verified_pairs(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Those of the distinct ``pairs`` (``a``, ``b``) whose texts' sets (``node``, ``text``) have at least that Jaccard similarity."""
    slots = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).alias("slots"))
    dealt = pairs.join(slots, "a").withColumn("slot", F.pmod(F.xxhash64("b"), "slots"))
    others = dealt.select("a", "slot", F.lit(1).alias("other"), F.col("b").alias("node"))
    firsts = dealt.select("a", "slot").distinct().select("a", "slot", F.lit(0).alias("other"), F.col("a").alias("node"))
    asked = stage(others.union(firsts), "asked")
    # Staged, so that few nodes are known to be few and the other texts need not be shuffled.
    nodes = stage(asked.select("node").distinct(), "asked-nodes")
    wanted = texts.join(nodes, "node", "left_semi").dropDuplicates(["node"])
    grouped = asked.join(wanted, "node").select("a", "slot", "other", "node", "text")
    ordered = grouped.repartition("a", "slot").sortWithinPartitions("a", "slot", "other")
    return ordered.mapInArrow(_verifier(shingle, similarity), "a long, b long")


def fingerprint_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``(a, b)`` of the nodes of ``prints`` (``node``, ``print``) that Golay keys bring together: nodes of one
    fingerprint with the smallest of them, and every fingerprint with the closest one linked to it."""
    distinct = stage(prints.groupBy("print").agg(F.min("node").alias("first")), "copy-prints")
    alike = prints.join(distinct, "print").filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    links = stage(print_links(distinct, radius), "copy-print-links")
    closest = links.groupBy("a").agg(F.min(F.struct(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("bits"), "b")).alias("to"))
    ends = closest.select("a", F.col("to.b").alias("b"))
    left, right = (distinct.select(F.col("print").alias(c), F.col("first").alias(f"{c}_node")) for c in "ab")
    linked = ends.join(left, "a").join(right, "b").select(F.col("b_node").alias("a"), F.col("a_node").alias("b"))
    return alike.union(linked).filter("a <> b").distinct()


def _band(similarity: float) -> Column:
    # A little wider than the sizes of sets alike enough, so that rounding parts none.
    width = max(-np.log(similarity), 1e-3) * (1 + 1e-6)
    return F.floor(F.log("size") / F.lit(float(width)))


def parity_sketch(held: np.ndarray) -> np.ndarray:
    """``SKETCH_WORDS`` words of bits, each the parity of the number of ``held`` that hash to it.  A shingle that only one
    of two sets holds turns one bit, so their sketches differ in no more bits than the sets in shingles."""
    bits = np.bincount((held % np.uint64(64 * SKETCH_WORDS)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _sketch_batches(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = np.array([parity_sketch(shingle_set(t.as_py(), shingle)) for t in batch.column("text")], np.int64).reshape(-1, SKETCH_WORDS)
            words = [pa.array(np.ascontiguousarray(sketches[:, i])) for i in range(SKETCH_WORDS)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *words], ["node", *(f"s{i}" for i in range(SKETCH_WORDS))])

    return run


def shared_prefixes(texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``key, band, node, size``: the rarest shingles of each set as far as sets of like size hold them too.

    Ordered from rare to frequent, of two sets alike enough one shares a shingle of its first ``size - ceil(similarity *
    size) + 1`` with those of the other; their sizes then lie in one band, each set being in two of them.
    """
    counted = texts.select("text").mapInArrow(_count_batches(shingle), "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    counts = np.zeros(COUNTERS, np.int64)
    for row in counted.toLocalIterator():
        counts[row["counter"]] = row["n"]
    keyed = texts.select("node", "text").mapInArrow(_prefix_batches(counts, shingle, similarity), "key long, node long, size int")
    keyed = stage(keyed.distinct(), "prefixes")
    many = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    band = _band(similarity)
    banded = keyed.join(many, "key").select("key", F.explode(F.array(band, band + 1)).alias("band"), "node", "size")
    shared = stage(banded, "shared-prefixes")
    release(keyed)
    return shared


def _next_pairs(active: DataFrame, tested: DataFrame, similarity: float) -> DataFrame:
    """For each set of ``active`` the one of its keys' leads outside its component that shares most keys with it, as
    distinct pairs ``(a, b)`` not in ``tested`` (``low``, ``high``); ``a`` is the lead."""
    near = F.least("size", "lead.size") >= similarity * F.greatest("size", "lead.size") - 1e-9
    met = active.select("node", "size", "root", F.explode(F.array("low", "high")).alias("lead")).filter((F.col("lead.root") != F.col("root")) & near)
    counted = met.groupBy("node", F.col("lead.node").alias("lead")).agg(F.count("*").alias("n"))
    ordered = counted.withColumns({"low": F.least("node", "lead"), "high": F.greatest("node", "lead")})
    best = ordered.join(tested, ["low", "high"], "left_anti").groupBy("node").agg(F.max(F.struct("n", "lead", "low", "high")).alias("best"))
    return best.select(F.col("best.lead").alias("a"), F.col("node").alias("b"), "best.low", "best.high").dropDuplicates(["low", "high"])


def _rest_pairs(shared: DataFrame, roots: DataFrame, tested: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """All distinct pairs ``(a, b)`` of sets in different components that share a (key, band), have near sizes and sketches
    and are not in ``tested``.

    Sets alike enough differ in at most ``(1 - similarity) / (1 + similarity)`` of their sizes' sum, and so do their
    sketches: pairs that differ in more are left out before they are rows, and none of those alike enough is.
    """
    rooted = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("key", "band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("key", "band")
    # Of two sets of one band both meet in the next one again, which is `upper` to both.
    upper = (F.col("band") > _band(similarity)).alias("upper")
    left = stage(rooted.join(mixed, ["key", "band"], "left_semi").select("key", "band", "node", "size", "root", upper), "rest")
    asked = stage(left.select("node").distinct(), "rest-nodes")
    words = [f"s{i}" for i in range(SKETCH_WORDS)]
    wanted = texts.join(asked, "node", "left_semi").dropDuplicates(["node"]).select("node", "text")
    sketches = stage(wanted.mapInArrow(_sketch_batches(shingle), ", ".join(["node long", *(f"{w} long" for w in words)])), "sketches")
    left = left.join(sketches, "node")
    right = left.select("key", "band", *[F.col(c).alias(f"other_{c}") for c in ("node", "size", "root", "upper", *words)])
    near = F.least("size", "other_size") >= similarity * F.greatest("size", "other_size") - 1e-9
    differing = reduce(Column.__add__, [F.bit_count(F.col(w).bitwiseXOR(F.col(f"other_{w}"))) for w in words])
    close = differing <= (1 - similarity) / (1 + similarity) * (F.col("size") + F.col("other_size")) + 1e-6
    once = (F.col("node") < F.col("other_node")) & ~(F.col("upper") & F.col("other_upper"))
    met = left.join(right, ["key", "band"]).filter(once & (F.col("root") != F.col("other_root")) & near & close)
    pairs = met.select(F.col("node").alias("low"), F.col("other_node").alias("high")).distinct().join(tested, ["low", "high"], "left_anti")
    return pairs.select(F.col("low").alias("a"), F.col("high").alias("b"))


def copy_links(texts: DataFrame, shingle: int = COPY_SHINGLE, similarity: float = SIMILARITY, rounds: int = ROUNDS) -> DataFrame:
    """``(node, root)`` of the components of pairs of ``texts`` (``node``, ``print``, ``text``) whose sets of shingles have at
    least that Jaccard similarity; nodes without such a partner may be left out.

    Candidates come from the Golay keys of the fingerprints first, then from shared rare shingles in rounds: every
    (key, band) names two leads of different components, and each set is compared with the lead it shares most
    keys with and has not met.  So a round compares at most one pair a set, however large groups are.  Rounds end
    when nothing new meets, when two in a row link nothing, or after ``rounds``.  They only make components large:
    after them every pair of different components that shares a key and was not compared is, unless its sketches
    show that it differs in too many shingles, so no link is lost.
    """
    first = stage(fingerprint_pairs(texts.select("node", "print")), "pairs")
    tested = first.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
    edges = stage(verified_pairs(first, texts, shingle, similarity), "copies")
    prefixes, idle = shared_prefixes(texts, shingle, similarity), 0
    shared, roots, active = prefixes, connected_components(edges), None
    for seed in range(rounds):
        rooted = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mark = F.struct(F.xxhash64(F.lit(seed), "root").alias("by_root"), F.xxhash64(F.lit(seed), "node").alias("by_node"), "node", "size", "root")
        ends = rooted.groupBy("key", "band").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).filter("low.root <> high.root")
        slim = [F.struct(f"{side}.node", f"{side}.size", f"{side}.root").alias(side) for side in ("low", "high")]
        before, active = active, stage(rooted.join(ends.select("key", "band", *slim), ["key", "band"]), "apart")
        if before is not None:
            release(before)
        pairs = stage(_next_pairs(active, tested, similarity), "pairs")
        if pairs.isEmpty():
            break
        found = stage(verified_pairs(pairs.select("a", "b"), texts, shingle, similarity), "copies")
        idle = idle + 1 if found.isEmpty() else 0
        shared, tested = active.select("key", "band", "node", "size"), tested.union(pairs.select("low", "high"))
        if idle == 2:
            break
        if not idle:
            edges = edges.union(found)
            roots = connected_components(edges)
        forget_shuffles(texts.sparkSession)
    rest = stage(_rest_pairs(prefixes, roots, tested, texts, shingle, similarity), "pairs")
    forget_shuffles(texts.sparkSession)
    if not rest.isEmpty():
        edges = edges.union(stage(verified_pairs(rest, texts, shingle, similarity), "copies"))
        roots = connected_components(edges)
    # The components come from the edges alone.
    for staged in (prefixes, active):
        if staged is not None:
            release(staged)
    return roots


def near_copies(docs: DataFrame, keys: list[str], shingle: int = COPY_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``keys`` (the first is the document id), ``component_id`` and ``class`` (one value for each group, also
    where ids repeat or are null) of near copies: texts that links between sets of word shingles with
    a Jaccard similarity of at least ``similarity`` connect.

    Similarity 0.8 is more than fingerprints can tell, so what their keys and rare shingles bring together is
    decided on the sets themselves: no pair below it is linked, none of it left out (sets are of 64-bit
    hashes).  Nulls, repeated rows and empty tables are treated as in ``near_duplicates``.
    """
    rows = docs.select(*keys, text_or_empty().alias("text"))
    kept = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes[:-1])
    made = stage(rows.mapInArrow(_set_batches(shingle), f"{kept}, node long, print long, text string"), "shingle-sets")
    roots = copy_links(made.filter("text is not null").select("node", "print", "text"), shingle, similarity)
    rooted = made.groupBy("node").agg(F.min(keys[0]).alias("first")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("node", "component_id", F.col("root").alias("class"))
    return made.join(classes, "node").select(*keys, "component_id", "class")


def op4_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op4_golay_simhash": op4_golay_simhash}
ORACLES: dict[str, str] = {}
