"""Tokens of two tokenizers aligned by the bytes that they cover.

Token intervals of both sides are sorted by start and their ends accumulated to a running maximum; a group
breaks where a start reaches it.  Inside a group overlapping pairs are expanded.  A blank between two other
characters always parts tokens of both tokenizers, so texts are cut there and every different unit
of a page is encoded and aligned once.

Pages carry their texts as unit codes.  Links are counted per page as documents that hold them, summed
over all pages, and the sums come back to the pages by key, so documents never meet in one task.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.llm.common import stage, table, text_or_empty
from annolake.llm.tokenbin import load_tokenizer
from annolake.llm.windows import page_slices
from annolake.llm.wordcodes import coded, different, gathered, give_back, in_one_text, loosened, one_text, run_sums, squeezed

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
PAGE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
#: Units whose links are counted at a time (more for a single longer document).
STEP_UNITS = 1 << 18
#: Different units that are aligned at a time.
STEP_ALIGNED = 1 << 15
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_BLANK = "▁"
#: Stands for the ids of a unit that a tokenizer does not give back.
FAILED = 2**32 - 1

# White space beside a blank, or a blank at either end of a text: no cut there (RE2 syntax).
_SPACE = r"\t\n\x0b\f\r\x1c-\x1f\x{85}\p{Z}"
_HARD = rf"[{_SPACE}] | [{_SPACE}]|\A | \z"
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Units that must not stand beside others: an inner blank, or white space at an end.
_ALONE = rf"(?s)\A.+ |[{_SPACE}]\z|\A [{_SPACE}]|{_BLANK}"


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class ByteSide:
    """Byte-level BPE; strings of special tokens are plain text."""

    def __init__(self, name: str) -> None:
        self.tokenizer = load_tokenizer(name)
        self.tokenizer.encode_special_tokens = True
        bytes_of = byte_characters()
        vocabulary = self.tokenizer.get_vocab()
        self.table: list[bytes] = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.table[i] = bytes(bytes_of[c] for c in token) if all(c in bytes_of for c in token) else token.encode()
        self.sizes = np.array([len(x) for x in self.table], np.int64)

    def lists(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit; a unit begins with a blank."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]


class PieceSide:
    """Sentence pieces with byte fallback, which put a blank before the text."""

    def __init__(self, name: str) -> None:
        import sentencepiece

        if not os.path.isabs(name):
            import public_tokenizers

            name = public_tokenizers.path(name)
        self.model = sentencepiece.SentencePieceProcessor(model_file=name)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(_BLANK in p.lstrip(_BLANK) for p in pieces):
            raise ValueError("a piece with an inner blank reaches over units")
        is_byte = [self.model.is_byte(i) for i in range(len(pieces))]
        self.table = [bytes([int(p[3:5], 16)]) if b else p.replace(_BLANK, " ").encode() for p, b in zip(pieces, is_byte, strict=True)]
        self.sizes = np.array([len(x) for x in self.table], np.int64)

    def lists(self, units: list[str]) -> list[list[int]]:
        return self.model.encode([u[1:] for u in units], num_threads=1)


class UnitEncoder:
    """Ids of units on one side."""

    def __init__(self, side: ByteSide | PieceSide) -> None:
        self.side = side

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.side.table[i] for i in ids])

    def _as_one(self, units: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        text = one_text(units, "")
        found = self.side.lists([text])[0]
        if self._bytes(found) != text.encode("utf-8", "surrogatepass"):
            return None
        ids = np.array(found, np.uint32)
        reached, ends = np.cumsum(self.side.sizes[ids]), np.cumsum(sizes)
        last = np.searchsorted(reached, ends)
        if (reached[last] != ends).any():
            return None
        return ids, np.diff(last + 1, prepend=0)

    def _each(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [], []
        for unit, found in zip(units, self.side.lists(units), strict=True):
            same = self._bytes(found) == unit.encode("utf-8", "surrogatepass")
            ids += found if same else []
            counts.append(len(found) if same else -1)
        return np.array(ids, np.uint32), np.array(counts, np.int64)

    def encode(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat ids, begin, count)`` of every unit; ``FAILED`` alone for one whose bytes differ."""

        def each(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
            ids, counts = self._each(some)
            bad = np.flatnonzero(counts < 0)
            ends = np.cumsum(np.maximum(counts, 0))
            return np.insert(ids, ends[bad], FAILED), np.abs(counts)

        odd = pc.match_substring_regex(units, _ALONE).to_numpy(zero_copy_only=False)
        return in_one_text(units, odd, self._as_one, each)


def coalesced(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, first)``: intervals by start, and where in that order a new group begins."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    first = np.ones(len(order), bool)
    first[1:] = starts[order][1:] >= reach[:-1]
    return order, first


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices ``(a, b)`` of all overlapping pairs; each side's own tokens are in order and apart."""
    low = np.searchsorted(b_ends, a_starts, side="right")
    high = np.searchsorted(b_starts, a_ends, side="left")
    counts = np.maximum(high - low, 0)
    return np.repeat(np.arange(len(a_starts)), counts), gathered(low, counts)


class Aligned:
    """All units of a page, aligned: per unit its tokens, groups as text, and links as keys."""

    def __init__(self, units: pa.Array, *encoders: UnitEncoder) -> None:
        sides, bad = [], np.zeros(len(units), bool)
        for encoder in encoders:
            flat, begins, counts = encoder.encode(units)
            sides.append([flat, begins, counts, encoder.side.sizes])
            some = np.flatnonzero(counts)
            bad[some[flat[begins[some]] == FAILED]] = True
        for side in sides:  # in unit order, without the units that have no tokens
            flat, begins, counts, sizes = side
            counts[bad] = 0
            ids = flat[gathered(begins, counts)].astype(np.int64)
            ends = np.cumsum(sizes[ids])
            side[:] = [ids, ends - sizes[ids], ends, counts]
        (self.a, a_starts, a_ends, self.n_a), (self.b, b_starts, b_ends, self.n_b) = sides
        self.bad = bad
        starts, ends = np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends])
        order, first = coalesced(starts, ends)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(first) - 1
        self.a_group, self.b_group = group[: len(self.a)], group[len(self.a) :]
        self.groups = int(first.sum())
        unit_of_a = np.repeat(np.arange(len(units)), self.n_a)
        owner = np.zeros(self.groups, np.int64)
        owner[self.a_group] = unit_of_a  # every group of two tilings has tokens of both sides
        self.n_groups = np.bincount(owner, minlength=len(units))
        left, right = overlaps(a_starts, a_ends, b_starts, b_ends)
        self.keys = (self.a[left] << 32) | self.b[right]
        self.n_links = np.bincount(unit_of_a[left], minlength=len(units))
        self.lines = "\n".join(self.texts().to_pylist()).encode()
        del self.a, self.b, self.a_group, self.b_group

    def texts(self) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` of every unit."""
        sides = []
        for ids, group in ((self.a, self.a_group), (self.b, self.b_group)):
            bounds = np.searchsorted(group, np.arange(self.groups + 1)).astype(np.int32)
            numbers = pa.ListArray.from_arrays(bounds, pa.array(ids).cast(pa.string()))
            sides.append(pc.binary_join(numbers, ","))
        each = pc.binary_join_element_wise(*sides, "|")
        bounds = np.concatenate([[0], np.cumsum(self.n_groups)]).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(bounds, each), ";")


class Units:
    """All units of a page, aligned some at a time: bounded scratch memory whatever the page's vocabulary."""

    def __init__(self, units: pa.Array, sides: tuple[UnitEncoder, UnitEncoder]) -> None:
        parts = [Aligned(units.slice(at, STEP_ALIGNED), *sides) for at in range(0, max(1, len(units)), STEP_ALIGNED)]
        together = lambda name: np.concatenate([getattr(p, name) for p in parts])
        self.bad, self.keys = together("bad"), together("keys")
        self.n_a, self.n_b, self.n_groups, self.n_links = (together(n) for n in _COUNTS)
        self.lines = b"\n".join(p.lines for p in parts)


def split_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``(all units, bounds)``: every text with a blank before it, cut before each blank between two other characters."""
    hard = pc.match_substring_regex(texts, _HARD)
    cut = pc.split_pattern(pc.if_else(hard, "", texts), " ")
    units = pc.binary_join_element_wise("", cut.flatten(), " ")
    bounds = cut.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    sizes, arrays, at = np.diff(bounds), [], 0
    for row in np.flatnonzero(hard.to_numpy(zero_copy_only=False)).tolist():  # other runs of blanks: one by one
        pieces = [" " + piece for piece in _CUT.split(texts[row].as_py())]
        arrays += [units.slice(int(bounds[at]), int(bounds[row] - bounds[at])), pa.array(pieces, pa.string())]
        sizes[row], at = len(pieces), row + 1
    arrays.append(units.slice(int(bounds[at])))
    return pa.concat_arrays(arrays), np.concatenate([[0], np.cumsum(sizes)])


_PAGE = """page long, bounds binary, codes binary, n_a binary, n_b binary, n_groups binary, n_links binary,
           texts binary, links binary, pairs array<long>, held array<int>"""


def _pager(byte_name: str, piece_name: str, carried: list[str]) -> Callable:
    def page(batch: pa.RecordBatch, number: int, sides: tuple) -> pa.RecordBatch:
        texts = batch.column("text")
        units, bounds = split_units(texts)
        known, codes = coded(units)
        found = Units(known, sides)
        sizes = np.diff(bounds)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        out = np.zeros(len(sizes), bool)
        out[owner[found.bad[codes]]] = True  # one unit without tokens, and its text has none
        out |= pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        codes, owner = codes[~out[owner]], owner[~out[owner]]
        bounds = np.concatenate([[0], np.cumsum(np.where(out, 0, sizes))])
        pairs, links = np.unique(found.keys, return_inverse=True)
        begins = np.cumsum(found.n_links) - found.n_links
        held = np.zeros(len(pairs), np.int64)
        # Documents that hold a link, some documents at a time: each of their units once, then each link once.
        cuts = np.unique(np.minimum(np.searchsorted(bounds, np.arange(0, len(codes) + STEP_UNITS, STEP_UNITS)), len(sizes)))
        for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            part = slice(bounds[low], bounds[high])
            once = different(owner[part] * len(known) + codes[part])
            doc, unit = np.divmod(once, max(1, len(known)))
            linked = links[gathered(begins[unit], found.n_links[unit])]
            pair_once = different(np.repeat(doc, found.n_links[unit]) * len(pairs) + linked)
            held += np.bincount(pair_once % max(1, len(pairs)), minlength=len(pairs))
        used = held > 0  # links of units that only texts without tokens have are no links
        slot = np.cumsum(used) - 1
        whole = lambda column: pa.ListArray.from_arrays([0, len(column)], column)
        packed = lambda values: pa.array([squeezed(values)], pa.binary())
        lines = np.frombuffer(found.lines.ljust(4), np.uint8)
        columns = {f"k_{c}": whole(batch.column(c)) for c in carried} | {
            "page": pa.array([number], pa.int64()), "bounds": packed(bounds), "codes": packed(codes), "n_a": packed(found.n_a),
            "n_b": packed(found.n_b), "n_groups": packed(found.n_groups), "n_links": packed(found.n_links), "texts": packed(np.pad(lines, (0, -len(lines) % 4)).view("<i4")),
            "links": packed(np.where(used[links], slot[links], 0)), "pairs": whole(pa.array(pairs[used])),
            "held": whole(pa.array(held[used].astype(np.int32))),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sides, number = None, TaskContext.get().partitionId() << 40
        for batch in batches:
            sides = sides or (UnitEncoder(ByteSide(byte_name)), UnitEncoder(PieceSide(piece_name)))
            for low, high in page_slices(batch.column("text"), PAGE_BYTES):
                yield page(batch.slice(low, high - low), number, sides)
                give_back()
                number += 1

    return run



def _finisher(carried: list[str]) -> Callable:
    def one(row: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        packed = lambda name: loosened(batch.column(name)[row].as_buffer())
        bounds, codes, links, per_unit = packed("bounds"), packed("codes"), packed("links"), {n: packed(n) for n in _COUNTS}
        found = batch.column("found")[row].values  # structs of position and number, or null
        count, best = np.zeros(0, np.int64), np.zeros(0, bool)
        if found is not None and len(found):
            at, value = (found.field(n).to_numpy(zero_copy_only=False) for n in ("at", "value"))
            count, best = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
            count[at], best[at] = value >> 1, value & 1 == 1
        of_unit = np.concatenate([[0], np.cumsum(per_unit["n_links"])])
        # Links of units that no counted text has point at 0 and are never added up.
        safe = links if len(count) else links[:0]
        per_unit["count_sum"] = run_sums(count[safe], of_unit) if len(count) else np.zeros(len(of_unit) - 1, np.int64)
        per_unit["n_best"] = run_sums(best[safe].astype(np.int64), of_unit) if len(count) else per_unit["count_sum"]
        lines = packed("texts").astype("<i4").tobytes().rstrip(b"\0 ").decode()
        texts = pa.array(lines.split("\n"), pa.string())
        held = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
        sizes = run_sums(held + 1, bounds)
        start, upto = 0, np.cumsum(sizes)
        while start < len(sizes):
            stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + BATCH_BYTES, side="right")))
            low, high = bounds[start], bounds[stop]
            lists = pa.ListArray.from_arrays((bounds[start : stop + 1] - low).astype(np.int32), texts.take(pa.array(codes[low:high])))
            columns = {c: batch.column(f"k_{c}")[row].values.slice(start, stop - start) for c in carried}
            columns |= {n: pa.array(run_sums(v[codes[low:high]], bounds[start : stop + 1] - low)) for n, v in per_unit.items()}
            columns["groups"] = pc.binary_join(lists, ";")
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
            start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                yield from one(row, batch)
                give_back()

    return run


def link_counts(pages: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that hold a pair linked, and whether no pair of its A id has more."""
    counted = pages.select(F.explode(F.arrays_zip("pairs", "held")).alias("x")).groupBy(F.col("x.pairs").alias("pair"))
    counts = stage(counted.agg(F.sum("x.held").alias("n")), "links")
    # One row per A id, so at most the vocabulary.
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), F.shiftright("pair", 32) == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, keys: list[str], byte_name: str = BYTE_TOKENIZER, piece_name: str = PIECE_TOKENIZER) -> DataFrame:
    """``keys, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` for every row of ``docs``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` in token ids.  Texts that are null or empty, or that one of the
    tokenizers does not give back byte by byte, have zeros and no groups.  Repeated rows count as documents
    of their own; ``keys`` may be null; other columns are not read; an empty table gives an empty one.
    Only the largest count per A id is broadcast.
    """
    carried = [f"c{i}" for i in range(len(keys))]
    rows = docs.select(*[F.col(k).alias(c) for k, c in zip(keys, carried, strict=True)], text_or_empty().alias("text"))
    kinds = dict(rows.dtypes)
    schema = ", ".join([*(f"k_{c} array<{kinds[c]}>" for c in carried), _PAGE])
    pages = stage(rows.mapInArrow(_pager(byte_name, piece_name, carried), schema), "aligned")
    asked = pages.select("page", F.posexplode("pairs").alias("at", "pair")).join(link_counts(pages), "pair")
    value = (F.shiftleft("n", 1) + F.col("best").cast("long")).alias("value")
    found = asked.groupBy("page").agg(F.collect_list(F.struct("at", value)).alias("found"))  # bounded by a page
    joined = pages.drop("pairs", "held").join(found, "page", "left")
    out = ", ".join([*(f"{c} {kinds[c]}" for c in carried), *(f"{n} long" for n in [*_COUNTS, "count_sum", "n_best"]), "groups string"])
    done = joined.mapInArrow(_finisher(carried), out)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return done.select(*[F.col(c).alias(k) for k, c in zip(keys, carried, strict=True)], *names)


def op13_interval_coalescing(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_documents(table(spark, sf_dir, "documents"), ["doc_id"])
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    return aligned.select(*[c for c in aligned.columns if c != "groups"], digest.alias("groups_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op13_interval_coalescing": op13_interval_coalescing}
ORACLES: dict[str, str] = {}
