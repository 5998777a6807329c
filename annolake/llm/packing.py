"""Documents packed into sequences by repeated length patterns.

Documents are encoded and cut into pieces of at most ``capacity`` tokens; from there only the
histogram of piece lengths (``capacity`` numbers at most) decides.  Lengths fall into classes of ``GRAIN``
tokens; every pattern of a few classes that fills a sequence is a column, and non-negative least squares
fits how often each is repeated.  Rounded and bounded by what there is, patterns take runs of pieces; what
remains goes, longest first, into the tightest room of all sequences, again as runs of equal ones.
The plan is a short table of runs: a piece finds its sequence and place from its length and its rank among
the pieces of that length, so no group of pieces is ever gathered in one task.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.llm.common import stage, table, text_or_empty
from annolake.llm.substring import split_words
from annolake.llm.tokenbin import load_tokenizer
from annolake.llm.windows import page_slices
from annolake.llm.wordcodes import Memory, coded, gathered, in_one_text, one_text, run_sums
from annolake.operators.ordered import with_rank

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
#: Tokens a length class spans, and documents a pattern has at most.
GRAIN = 16
PARTS = 3
#: Pieces up to this part of the capacity are no part of patterns: they fill what patterns leave open.
FILLER = 1 / 32
PAGE_BYTES = 4 << 20
#: Bytes of ids that leave a task in one batch.
BATCH_BYTES = 8 << 20

# Spaces inside a word, which the tokenizer drops (RE2 syntax).
_INNER_SPACE = r"[\x1c-\x1f\x{85}\p{Z}]"
_WORD_END = "</w>"
# A full stop or comma between a letter and white space is a token of its own.
_END_MARK = r"([a-z])([.,])(\s|\z)"


class WordEncoder:
    """A tokenizer that drops white space and ends words, as a function of single words."""

    def __init__(self, name: str) -> None:
        self.tokenizer = load_tokenizer(name)
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        # One character of a byte-level token stands for one byte.
        self.sizes[list(vocabulary.values())] = [len(token.removesuffix(_WORD_END)) for token in vocabulary]

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((i for x in lists for i in x), np.uint32, int(counts.sum())), counts

    def _as_one(self, words: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        ids = np.array(self.tokenizer.encode_batch_fast([one_text(words, " ")], add_special_tokens=False)[0].ids, np.uint32)
        reached, ends = np.cumsum(self.sizes[ids]), np.cumsum(sizes)
        last = np.searchsorted(reached, ends)
        if not len(reached) or reached[-1] != ends[-1] or (reached[last] != ends).any():
            return None
        return ids, np.diff(last + 1, prepend=0)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat ids, begin, count)`` of every word."""
        special = pc.match_substring(words, "<|")  # special tokens are found before anything is normalised
        foreign = pc.invert(pc.or_(special, pc.string_is_ascii(words)))
        composed = [unicodedata.normalize("NFC", word) for word in words.filter(foreign).to_pylist()]
        if composed:
            words = pc.replace_with_mask(words, foreign, pa.array(composed, words.type))
        shaped = pc.not_equal(pc.binary_length(pc.utf8_lower(words)), pc.binary_length(words))
        odd = pc.or_(pc.or_(special, shaped), pc.match_substring_regex(words, _INNER_SPACE))
        return in_one_text(words, odd.to_numpy(zero_copy_only=False), self._as_one, self._each)


def alike(texts: pa.Array) -> pa.Array:
    """Texts with the same tokens and fewer different words: lower case, marks at a word's end apart."""
    apart = pc.replace_substring_regex(pc.ascii_lower(texts), _END_MARK, r"\1 \2\3")
    return pc.if_else(pc.match_substring(texts, "<|"), texts, apart)


_PIECES = "row long, piece int, start long, length long, ids binary"


def _encoder(name: str, capacity: int, end_id: int, carried: list[str]) -> Callable:
    def page(memory: Memory, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(all ids, ids per text)``, end ids included."""
        words, bounds = split_words(alike(texts))
        known, codes = coded(words)
        flat, begins, counts = memory.lookup(known)
        ids = flat[gathered(begins[codes], counts[codes])]
        sizes = run_sums(counts[codes], bounds)
        return np.insert(ids, np.cumsum(sizes), end_id), sizes + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memory, row = None, TaskContext.get().partitionId() << 40
        for batch in batches:
            memory = memory or Memory(WordEncoder(name).encode)
            texts = batch.column("text")
            for low, high in page_slices(texts, PAGE_BYTES):
                ids, sizes = page(memory, texts.slice(low, high - low))
                data, pieces = ids.astype("<u4").tobytes(), -(-sizes // capacity)
                document = np.repeat(np.arange(len(sizes)), pieces)
                nth = gathered(np.zeros(len(sizes), np.int64), pieces)
                start = nth * capacity
                length = np.minimum(sizes[document] - start, capacity)
                ends = np.cumsum(length)
                step = max(1, BATCH_BYTES // (4 * capacity))
                for a in range(0, len(document), step):
                    b = min(a + step, len(document))
                    bounds = zip((ends[a:b] - length[a:b]).tolist(), ends[a:b].tolist(), strict=True)
                    columns = [
                        *(batch.column(c).take(pa.array(document[a:b] + low)) for c in carried),
                        pa.array(row + np.arange(a, b)), pa.array(nth[a:b].astype(np.int32)), pa.array(start[a:b]),
                        pa.array(length[a:b]), pa.array([data[4 * x : 4 * y] for x, y in bounds], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, [*carried, "row", "piece", "start", "length", "ids"])
                row += len(document)

    return run


def encoded_pieces(docs: DataFrame, keys: list[str], tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``keys, row, piece, start, length, ids`` (little-endian unsigned 32-bit) of each document's pieces, written once."""
    carried = [f"_k{i}" for i in range(len(keys))]
    rows = docs.select(*[F.col(k).alias(c) for k, c in zip(keys, carried, strict=True)], text_or_empty().alias("text"))
    schema = ", ".join([*(f"{n} {t}" for n, t in rows.drop("text").dtypes), _PIECES])
    staged = stage(rows.mapInArrow(_encoder(tokenizer, capacity, end_id, carried), schema), "pieces")
    return staged.select(*[F.col(c).alias(k) for k, c in zip(keys, carried, strict=True)], "row", "piece", "start", "length", "ids")


def non_negative_least_squares(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``x >= 0`` with the least ``|matrix x - target|``, by an active set of columns."""
    columns = matrix.shape[1]
    x, active = np.zeros(columns), np.zeros(columns, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(matrix.T @ target).max(initial=0)))
    for _ in range(3 * columns):
        gain = matrix.T @ (target - matrix @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain)) if columns else 0
        if not columns or gain[best] <= tolerance:
            break
        active[best] = True
        while True:
            chosen = np.flatnonzero(active)
            trial = np.linalg.lstsq(matrix[:, chosen], target, rcond=None)[0]
            if (trial > 0).all():
                x[:] = 0
                x[chosen] = trial
                break
            # Go towards the trial until the first column reaches zero, and let that one go.
            falling = trial <= 0
            ratio = x[chosen][falling] / np.maximum(x[chosen][falling] - trial[falling], 1e-300)
            x[chosen] += float(ratio.min()) * (trial - x[chosen])
            active[chosen[falling][ratio <= ratio.min()]] = False
            active[chosen[x[chosen] <= 0]] = False
            x[~active] = 0
    return x


def patterns(units: int, parts: int) -> np.ndarray:
    """All ways to write ``units`` as a sum of at most ``parts`` positive numbers: one row of counts per way."""
    found: list[tuple[int, ...]] = []

    def extend(left: int, most: int, head: tuple[int, ...]) -> None:
        if not left:
            found.append(head)
        elif len(head) < parts:
            for part in range(min(left, most), 0, -1):
                if part * (parts - len(head)) < left:
                    break
                extend(left - part, part, (*head, part))

    extend(units, units, ())
    out = np.zeros((len(found), units + 1), np.int64)
    for row, way in enumerate(found):
        np.add.at(out[row], list(way), 1)
    return out


def pattern_repeats(histogram: np.ndarray, units: int, parts: int) -> list[tuple[list[int], int]]:
    """``(classes, repeats)`` of the patterns to use, for ``histogram`` (pieces per class, 1 to ``units``)."""
    histogram = np.where(np.arange(units + 1) > units * FILLER, histogram, 0)
    ways = patterns(units, parts)
    ways = ways[((ways == 0) | (histogram > 0)).all(axis=1)]
    weight = np.arange(units + 1, dtype=float)  # a piece matters by its tokens
    fit = non_negative_least_squares((ways * weight).T.astype(float), histogram * weight)
    left, out = histogram.copy(), []
    for row in np.argsort(-fit, kind="stable"):
        used = np.flatnonzero(ways[row])
        repeats = min(int(np.floor(fit[row] + 0.5)), *(left[used] // ways[row][used]).tolist())
        if repeats > 0:
            left[used] -= repeats * ways[row][used]
            out.append((np.repeat(used, ways[row][used])[::-1].tolist(), repeats))
    return out


#: A run of equal sequences: how many, and ``(length, copies)`` of what each holds.
Run = tuple[int, tuple[tuple[int, int], ...]]


def _pattern_runs(counts: np.ndarray, grain: int, parts: int) -> tuple[list[Run], np.ndarray]:
    """The runs that patterns make, and the pieces per length that they leave.

    All but the smallest class of a pattern give their longest pieces; the smallest one is then
    chosen by exact length, so that most sequences are filled to the last token.
    """
    capacity, left, runs = len(counts) - 1, counts.copy(), []
    units = capacity // grain
    if units * grain != capacity or not counts.any():
        return runs, left
    classes = -(-np.arange(capacity + 1) // grain)
    for used, repeats in pattern_repeats(np.bincount(classes, counts, units + 1).astype(np.int64), units, parts):
        slots: list[list[tuple[int, int]]] = []
        for nth, one in enumerate(used[:-1]):
            lengths = range(one * grain, (one - 1) * grain, -1)
            again = used[nth:-1].count(one)  # earlier patterns may have chosen from this class
            repeats = min(repeats, sum(int(left[x]) for x in lengths) // again)
            need, taken = repeats, []
            for length in lengths:
                if some := min(need, int(left[length])):
                    taken.append((length, some))
                    left[length] -= some
                    need -= some
            slots.append(taken)
        for taken in slots:  # a later slot may have had fewer
            over = sum(n for _, n in taken) - repeats
            while over > 0:
                length, some = taken.pop()
                back = min(over, some)
                left[length] += back
                over -= back
                if some > back:
                    taken.append((length, some - back))
        if not repeats:
            continue
        ends = [np.cumsum([n for _, n in taken]) for taken in slots]
        cuts = np.unique(np.concatenate([np.array([repeats]), *ends]))
        of = [np.array([x for x, _ in taken])[np.searchsorted(end, cuts)] for taken, end in zip(slots, ends, strict=True)]
        for size, *lengths in zip(np.diff(cuts, prepend=0).tolist(), *(x.tolist() for x in of), strict=True):
            held = tuple((x, 1) for x in lengths)
            for length in range(capacity - sum(lengths), (used[-1] - 1) * grain, -1):
                if some := min(size, int(left[length])):
                    runs.append((some, (*held, (length, 1))))
                    left[length] -= some
                    size -= some
                if not size:
                    break
            if size and held:
                runs.append((size, held))
    return runs, left


def plan_runs(counts: np.ndarray, grain: int = GRAIN, parts: int = PARTS) -> list[Run]:
    """Runs of sequences for ``counts[length]`` pieces of each length, ``len(counts) - 1`` being the capacity."""
    capacity = len(counts) - 1
    runs, left = _pattern_runs(counts, grain, parts)
    rooms: dict[int, list[Run]] = defaultdict(list)
    for run in runs:
        rooms[capacity - sum(x * n for x, n in run[1])].append(run)
    for length in range(capacity, 0, -1):  # the longest first, each into the tightest room
        need = int(left[length])
        for room in range(length, capacity) if need else ():
            copies = room // length
            while need and rooms.get(room):
                size, held = rooms[room].pop()
                full = min(size, need // copies)
                rest = need - full * copies if full < size and need - full * copies < copies else 0
                if full:
                    rooms[room - copies * length].append((full, (*held, (length, copies))))
                if rest:
                    rooms[room - rest * length].append((1, (*held, (length, rest))))
                if over := size - full - bool(rest):
                    rooms[room].append((over, held))
                need -= full * copies + rest
            if not need:
                break
        copies = capacity // length
        if full := need // copies:
            rooms[capacity - copies * length].append((full, ((length, copies),)))
        if rest := need % copies:
            rooms[capacity - rest * length].append((1, ((length, rest),)))
    return [run for room in sorted(rooms) for run in rooms[room]]


def segments(runs: list[Run]) -> np.ndarray:
    """Rows ``length, first rank, copies, first sequence, offset``, ordered by length and rank.

    Piece ``rank`` of ``length`` lies in sequence ``first sequence + (rank - first rank) // copies``.
    """
    out, ranks, sequence = [], defaultdict(int), 0
    for size, held in runs:
        offset = 0
        for length, copies in held:
            out.append((length, ranks[length], copies, sequence, offset))
            ranks[length] += size * copies
            offset += length * copies
        sequence += size
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def _placer(plan: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, copies, sequence, offset = plan.T
        places = (length << 48) + first
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(places, (size << 48) + rank - 1, side="right") - 1
            nth = rank - 1 - first[at]
            columns = [batch.column("row"), pa.array(sequence[at] + nth // copies[at]), pa.array(offset[at] + nth % copies[at] * size)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "sequence_id", "offset"])

    return run


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN, parts: int = PARTS) -> DataFrame:
    """``row, sequence_id, offset`` for ``row`` and ``length`` (1 to ``capacity``) of every piece."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = n
    plan = segments(plan_runs(counts, grain, parts))
    ranked = with_rank(pieces.select("row", "length"), ["length"], ["row"])
    return ranked.mapInArrow(_placer(plan), "row long, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    keys: list[str],
    tokenizer: str = TOKENIZER,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    grain: int = GRAIN,
    parts: int = PARTS,
) -> DataFrame:
    """``keys, piece, start, length, ids, sequence_id, offset``: every piece, its ids and its place.

    Null and empty texts are the end id alone; repeated rows are all packed; ``keys`` may be null; other
    columns are not read; an empty table gives an empty one.  Documents of more than ``capacity`` ids, the
    end id included, are cut into pieces of ``capacity``.  ``ids`` is binary, 4 bytes each.  The driver holds
    the length histogram and the plan, which grow with ``capacity`` and not with the documents.
    """
    pieces = encoded_pieces(docs, keys, tokenizer, capacity, end_id)
    placed = assign_sequences(pieces, capacity, grain, parts)
    return pieces.join(placed, "row").drop("row")


def op12_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), ["doc_id"])
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op12_pattern_packing": op12_pattern_packing}
ORACLES: dict[str, str] = {}
