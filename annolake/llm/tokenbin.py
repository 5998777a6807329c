"""Token ids as fixed-width bit-packed binary files.

Documents are range-partitioned and sorted by id, encoded, and every partition becomes one file of
blocks.  A block holds whole documents: a header, their ids and token counts, then all token ids in
``width`` bits each, 64 ids to a frame of ``width`` little-endian 64-bit words.  Frame ``i // 64``
of token ``i`` lies at a computable place, so a reader unpacks any range with numpy.  The last
block of a file lists where each other block begins and how many tokens come before it, and ends with its own
place: a reader gets from the end of the file to any token by two short reads.

Layout (little-endian): magic ``FWB1``, width u8, kind u8 (0 tokens, 1 offsets), part u32, entries
u32, tokens u64, bytes of what follows u64.  Tokens block: entries x (doc id i64, count u64), frames.
Offsets block: entries x (offset u64), entries x (tokens before u64), own offset u64.  One byte 0x0A follows each
block.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolake.llm.common import table, text_key, text_or_empty
from annolake.llm.windows import page_slices
from annolake.llm.wordcodes import gathered, give_back, in_one_text, one_text
from annolake.session import staging_path

TOKENIZER = "byte_bpe_50k.json"
VOCABULARY = 50_257
END_ID = 0
#: Text bytes that one file takes, and that one block takes at most (but for a single longer document).
FILE_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
#: Bytes that a task's remembered words and their ids take before it starts afresh, and those of one word.
MEMORY_BYTES = 48 << 20
WORD_BYTES = 32

_HEAD = "<4sBBIIQQ"
_NULL_ID = -(2**63)
# White space that a cut at single blanks would tear apart (RE2 syntax).
_SPACE = r"\t\n\x0b\f\r\x1c-\x1f\x{85}\p{Z}"
_ODD = r"\t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_RUNS = rf"[{_SPACE}][{_SPACE}]|[{_ODD}]|\A[{_SPACE}]|[{_SPACE}]\z"


def width_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in ``width`` bits each, whole frames of 64 ids."""
    frames = -(-len(ids) // 64)
    padded = np.zeros(frames * 64, np.uint64)
    padded[: len(ids)] = ids
    lanes, out = padded.reshape(frames, 64), np.zeros((frames, width), "<u8")
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        out[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return out.tobytes()


def unpack(buffer: bytes, width: int, start: int, stop: int, offset: int = 0) -> np.ndarray:
    """Ids ``start`` to ``stop`` (exclusive) of frames that begin at ``offset`` of ``buffer``."""
    if stop <= start:
        return np.zeros(0, np.uint32)
    first, last = start // 64, -(-stop // 64)
    words = np.frombuffer(buffer, "<u8", (last - first) * width, offset + first * width * 8).reshape(-1, width)
    out, mask = np.empty((last - first, 64), np.uint32), np.uint64((1 << width) - 1)
    for lane in range(64):
        word, shift = divmod(lane * width, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, lane] = value & mask
    return out.reshape(-1)[start - first * 64 : stop - first * 64]


def tokens_block(part: int, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    body = doc_ids.astype("<i8").tobytes() + counts.astype("<u8").tobytes() + pack(ids, width)
    return struct.pack(_HEAD, b"FWB1", width, 0, part, len(doc_ids), len(ids), len(body)) + body


def blocks(buffer: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """``(width, part, doc ids, counts, offset of the frames)`` of each tokens block of a file."""
    at = 0
    while at < len(buffer):
        magic, width, kind, part, entries, _, size = struct.unpack_from(_HEAD, buffer, at)
        if magic != b"FWB1":
            raise ValueError(f"no block at byte {at}")
        body = at + struct.calcsize(_HEAD)
        if kind == 0:
            doc_ids = np.frombuffer(buffer, "<i8", entries, body)
            counts = np.frombuffer(buffer, "<u8", entries, body + 8 * entries).astype(np.int64)
            yield width, part, doc_ids, counts, body + 16 * entries
        at = body + size + 1


def read_range(read: Callable[[int, int], bytes], size: int, start: int, stop: int) -> np.ndarray:
    """Random access: tokens ``start`` to ``stop`` (exclusive) of a file of ``size`` bytes.

    ``read(offset, length)`` gives bytes of the file.  Besides the offsets block only the heads of the blocks and
    the frames that hold the range are read.
    """
    head = struct.calcsize(_HEAD)
    if size == 0:
        raise IndexError(start)
    (index,) = struct.unpack("<Q", read(size - 9, 8))
    magic, _, kind, _, entries, total, _ = struct.unpack(_HEAD, read(index, head))
    if (magic, kind) != (b"FWB1", 1):
        raise ValueError("the file does not end with an offsets block")
    if not 0 <= start <= stop <= total:
        raise IndexError(f"{start} to {stop} of {total}")
    places, before = np.frombuffer(read(index + head, 16 * entries), "<u8").astype(np.int64).reshape(2, entries)
    found = [np.zeros(0, np.uint32)]
    for at in range(int(np.searchsorted(before, start, "right")) - 1, entries):
        base = int(before[at])
        if base >= stop:
            break
        _, width, _, _, docs, tokens, _ = struct.unpack(_HEAD, read(int(places[at]), head))
        first, last = max(start - base, 0), min(stop - base, tokens)
        frames, upto = first // 64, -(-last // 64)
        raw = read(int(places[at]) + head + 16 * docs + frames * width * 8, (upto - frames) * width * 8)
        found.append(unpack(raw, width, first - frames * 64, last - frames * 64))
    return np.concatenate(found)


def read_token(buffer: bytes, index: int) -> int:
    """The token at ``index`` of a whole file in memory."""
    return int(read_range(lambda at, n: buffer[at : at + n], len(buffer), index, index + 1)[0])


class _Words:
    """Ids of words met before in a task, all in Arrow and numpy arrays; ``encode`` gives ``(flat ids, begin, count)`` of new ones."""

    def __init__(self, encode: Callable[[pa.Array], tuple]) -> None:
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.flat, self.begins, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def lookup(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat ids, begin, count)`` of every word; words are different."""
        if self.known.nbytes + self.flat.nbytes + self.begins.nbytes + self.counts.nbytes > MEMORY_BYTES:
            self.forget()
        slot = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy(zero_copy_only=False)
        new, old = np.flatnonzero(slot < 0), slot >= 0
        some = words.take(pa.array(new))
        flat, begins, counts = self.encode(some)
        before = len(self.flat)
        every_begin, every_count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        every_begin[old], every_count[old] = self.begins[slot[old]], self.counts[slot[old]]
        every_begin[new], every_count[new] = before + begins, counts
        ids = np.concatenate([self.flat, flat])
        short = np.flatnonzero(pc.less_equal(pc.binary_length(some), WORD_BYTES).to_numpy(zero_copy_only=False))
        kept = counts[short]
        self.known = pa.concat_arrays([self.known, some.take(pa.array(short))])
        self.begins = np.concatenate([self.begins, before + np.cumsum(kept) - kept])
        self.flat = np.concatenate([self.flat, flat[gathered(begins[short], kept)]])
        self.counts = np.concatenate([self.counts, kept])
        return ids, every_begin, every_count


class _Encoder:
    """Encodes texts whose words repeat; ids of words met before in the task are remembered."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        # One character of a byte-level token stands for one byte.
        self.sizes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.memory = _Words(self._words)

    def each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(all ids, ids per text)``, one by one."""
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((i for x in lists for i in x), np.uint32, int(counts.sum())), counts

    def _as_one(self, words: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Words that each follow a blank, as one text; the bytes that ids stand for tell where a word ends."""
        text = " " + one_text(words, " ")
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        reached, ends = np.cumsum(self.sizes[ids]), np.cumsum(sizes + 1)
        last = np.searchsorted(reached, ends)
        if last[-1] >= len(reached) or (reached[last] != ends).any():
            return None
        return ids, np.diff(last + 1, prepend=0)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat ids, begin, count)`` of words that follow a blank."""
        return in_one_text(words, np.zeros(len(words), bool), self._as_one, lambda some: self.each([" " + w for w in some]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(all ids, ids per text)``.

        Byte-level pre-tokens never reach over a single blank between two other characters, so a
        text is the sum of its blank-separated pieces and each different piece is encoded once.
        Texts with other white space go to the tokenizer whole.
        """
        whole = pc.match_substring_regex(texts, _RUNS)
        cut = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        pieces, bounds = cut.values.dictionary_encode(), cut.offsets.to_numpy().astype(np.int64)
        words, codes = pieces.dictionary, pieces.indices.to_numpy().astype(np.int64)
        first = np.zeros(len(codes), bool)
        first[bounds[:-1]] = True  # every text has a first piece, which no blank precedes
        used = np.zeros(len(words), bool)
        used[codes[~first]] = True
        later = np.flatnonzero(used)
        flat, begin, every = self.memory.lookup(words.take(pa.array(later)))
        heads, head_counts = self.each(words.take(pa.array(codes[first])).to_pylist())
        begins = np.concatenate([begin, len(flat) + np.cumsum(head_counts) - head_counts])  # where each piece's ids lie in `flat`
        flat, every = np.concatenate([flat, heads]), np.concatenate([every, head_counts])
        slot = np.zeros(len(words), np.int64)
        slot[later] = np.arange(len(later))
        at = slot[codes]
        at[bounds[:-1]] = len(later) + np.arange(len(head_counts))
        count = every[at]
        ends = np.cumsum(count)
        ids = flat[np.repeat(begins[at] - (ends - count), count) + np.arange(int(count.sum()))]
        upto = np.concatenate([[0], ends])
        counts = upto[bounds[1:]] - upto[bounds[:-1]]
        if not pc.any(whole).as_py():
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for row in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            parts[row] = np.array(self.tokenizer.encode(texts[row].as_py(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)


def load_tokenizer(name: str):
    """A path, or the name of a file of the public vocabulary package, found on the machine that asks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if not os.path.isabs(name):
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Tokenizer.from_file(name)


def _writer(tokenizer_name: str, width: int, end_id: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, total, encoder = TaskContext.get().partitionId(), 0, 0, None
        places, before = [], []
        for batch in batches:
            encoder = encoder or _Encoder(load_tokenizer(tokenizer_name))
            for start, stop in page_slices(batch.column("text"), BLOCK_BYTES):
                rows = batch.slice(start, stop - start)
                ids, counts = encoder.encode(rows.column("text"))
                closed = np.insert(ids, np.cumsum(counts), end_id)
                doc_ids = pc.fill_null(rows.column("doc_id"), _NULL_ID).to_numpy(zero_copy_only=False)
                block = tokens_block(part, doc_ids, counts + 1, closed, width)
                places.append(at)
                before.append(total)
                at += len(block) + 1
                total += len(closed)
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], ["value"])
        if places:
            body = np.array([*places, *before, at], "<u8").tobytes()
            index = struct.pack(_HEAD, b"FWB1", width, 1, part, len(places), total, len(body)) + body
            yield pa.RecordBatch.from_arrays([pa.array([index], pa.binary())], ["value"])
        del encoder
        give_back()

    return write


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    vocabulary: int = VOCABULARY,
    end_id: int = END_ID,
    file_bytes: int = FILE_BYTES,
) -> str:
    """Encode ``doc_id, text`` of ``docs`` into files below ``path``, ascending by doc id.

    Null text is empty and gives the end id alone; a null doc id comes first.  Rows of one doc id stand in
    order of their text's hash; repeated rows are all written.  Other columns are not read.  An
    empty table gives files without blocks.  The number of files follows the bytes of text.
    """
    if end_id >= vocabulary:
        raise ValueError("the end id is outside the vocabulary")
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = ["doc_id", text_key()]
    files = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // file_bytes))
    ordered = rows.repartitionByRange(int(files), *order).sortWithinPartitions(*order)
    packed = ordered.mapInArrow(_writer(tokenizer, width_for(vocabulary), end_id), "value binary")
    packed.select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)
    return path


def _reader(with_ids: bool) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                buffer, before = content.as_buffer(), 0
                for width, part, doc_ids, counts, offset in blocks(buffer):
                    total = int(counts.sum())
                    ids = unpack(buffer, width, 0, total, offset).astype("<u4")
                    ends = np.cumsum(counts)
                    sums = [zlib.crc32(ids[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                    columns = [
                        pa.array([part] * len(counts), pa.int32()),
                        pa.array(doc_ids, pa.int64(), mask=doc_ids == _NULL_ID),
                        pa.array(before + ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(sums, pa.int64()),
                    ]
                    names = ["part", "doc_id", "_from", "n_tokens", "ids_crc32"]
                    if with_ids:
                        bounds = np.concatenate([[0], ends]).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32))))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)
                    before += total

    return read


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            found = [(part, int(counts.sum())) for _, part, _, counts, _ in blocks(content.as_buffer())]
            parts, sums = [p for p, _ in found], [n for _, n in found]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(sums, pa.int64())], ["part", "n"])


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files below ``path``: ``doc_id, start, n_tokens, ids_crc32``
    and, if asked for, ``ids``.  ``start`` counts the ids of all documents before it."""
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = "part int, doc_id long, _from long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    rows = files.mapInArrow(_reader(with_ids), schema)
    # One row per file; their number follows the bytes of text over FILE_BYTES.
    sums = files.mapInArrow(_totals, "part int, n long").groupBy("part")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.agg(F.sum("n").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    return rows.join(offsets, "part").select(
        "doc_id",
        (F.col("_before") + F.col("_from")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def op8_bit_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_tokens(table(spark, sf_dir, "documents"), staging_path(spark, "tokens"))
    return read_tokens(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op8_bit_packed_tokens": op8_bit_packed_tokens}
ORACLES: dict[str, str] = {}
