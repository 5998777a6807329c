"""Quality by importance resampling: hashed n-gram models of target and raw text, Gumbel top-k.

Word and punctuation tokens give unigrams and bigrams, hashed into ``BUCKETS`` buckets.  The raw model counts all
documents, the target model the documents that a bounded sample of labels calls good.  A
document's score is the mean log ratio of target to raw over its n-grams.  Documents are then
drawn without replacement, with weights ``exp(score / temperature)``: each gets a Gumbel key and the
``k`` largest are kept.  ``k`` is the number of documents whose score reaches the threshold that
parts good from bad labels best.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.llm.common import stage, table, text_or_empty
from annolake.llm.windows import mix, page_slices
from annolake.operators.ordered import with_rank

#: Buckets of the hashed models (a power of two); the models and the table of ratios have this many entries.
BUCKETS = 1 << 14
#: Labelled documents that the target model and the threshold are fitted on at most.
FIT_ROWS = 20_000
TEMPERATURE = 0.005
SMOOTHING = 1.0
SEED = 7
PIECE_BYTES = 2 << 20

TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Bigrams of one token twice share a bucket, so that repetition is one feature.
_TWICE = 0xD1B54A32D192ED03


def grams(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, bucket)`` of all unigrams and bigrams of ``texts``."""
    import xxhash

    lists = [TOKEN.findall(text) for text in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    coded = pa.array([token for tokens in lists for token in tokens], pa.string()).dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    values = np.fromiter((digest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    tokens = values[coded.indices.to_numpy()]
    owner = np.repeat(np.arange(len(texts)), sizes)
    pairs = np.flatnonzero(owner[1:] == owner[:-1])
    left, right = tokens[pairs], tokens[pairs + 1]
    both = np.where(left == right, np.uint64(_TWICE), left * np.uint64(0x9E3779B97F4A7C15) + right)
    hashed = mix(np.concatenate([tokens, both])) & np.uint64(buckets - 1)
    return np.concatenate([owner, owner[pairs]]), hashed.astype(np.int64)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start, stop in page_slices(batch.column("text"), PIECE_BYTES):
        yield batch.slice(start, stop - start)


def _counter(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in _pieces(batch):
                owner, hashed = grams(piece.column("text").to_pylist(), buckets)
                good = piece.column("good").to_numpy(zero_copy_only=False)
                raw += np.bincount(hashed, minlength=buckets)
                target += np.bincount(hashed[good[owner]], minlength=buckets)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"]
        )

    return run


def label_sample(labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """At most ``rows`` labels, chosen by the hash of the id: ``label_id, good``.  Ids with several
    labels count as good if all of them say so; null ids and qualities are left out."""
    clear = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    chosen = clear.groupBy(F.col("doc_id").alias("label_id")).agg(F.min(F.expr("quality = 1")).alias("good"))
    return chosen.orderBy(F.xxhash64("label_id"), "label_id").limit(rows)


def fit_ratios(marked: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratio of target to raw per bucket, from ``text`` and ``good`` of all rows of ``marked``."""
    rows = marked.select("text", F.coalesce("good", F.lit(False)).alias("good"))
    counted = rows.mapInArrow(_counter(buckets), "bucket int, raw long, target long")
    sums = counted.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()  # at most `buckets` rows
    raw, target = np.full(buckets, smoothing), np.full(buckets, smoothing)
    for bucket, raw_count, target_count in sums:
        raw[bucket] += raw_count
        target[bucket] += target_count
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _scorer(ratios: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in _pieces(batch):
                owner, hashed = grams(piece.column("text").to_pylist(), len(ratios))
                counts = np.bincount(owner, minlength=len(piece))
                sums = np.bincount(owner, weights=ratios[hashed], minlength=len(piece))
                columns = [*piece.drop_columns(["text"]).columns, pa.array(counts), pa.array(sums / np.maximum(counts, 1))]
                names = [n for n in piece.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays(columns, [*names, "n_grams", "score"])

    return run


def best_threshold(scores: np.ndarray, good: np.ndarray) -> float:
    """The cut with the highest balanced accuracy, in the middle of its gap; without both kinds, no cut."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    ranked, truth = scores[order], good[order]
    below_bad = np.concatenate([[0], np.cumsum(~truth)]) / (~truth).sum()
    above_good = 1 - np.concatenate([[0], np.cumsum(truth)]) / truth.sum()
    value = below_bad + above_good
    edges = np.concatenate([[True], ranked[1:] > ranked[:-1], [True]])
    value[~edges] = -1
    best = np.flatnonzero(value >= value.max() - 1e-12)
    at = int(best[len(best) // 2])
    if at == 0:
        return -np.inf
    return float((ranked[at - 1] + ranked[at]) / 2) if at < len(ranked) else float(np.nextafter(ranked[-1], np.inf))


def importance_sample(
    docs: DataFrame,
    labels: DataFrame,
    keys: list[str],
    buckets: int = BUCKETS,
    fit_rows: int = FIT_ROWS,
    temperature: float = TEMPERATURE,
    seed: int = SEED,
) -> DataFrame:
    """``keys`` (the first is the document id), ``n_grams, score, gumbel_key, rank, selected`` for every row.

    ``rank`` orders all rows by the Gumbel key, the largest first, ties by key columns; the first
    ``k`` are selected.  Noise comes from the hash of the keys and the seed, so reruns agree and repeated
    rows share their key.  Null and empty texts have no n-grams and score 0, neither target-like
    nor not.  Without labels of both kinds every row is selected.  Other columns are not read; an
    empty table gives an empty one.  Only the label sample (``fit_rows``) and the models
    (``buckets``) reach the driver or are broadcast.
    """
    sample = stage(label_sample(labels, fit_rows), "labels")
    rows = docs.select(*keys, text_or_empty().alias("text"))
    marked = rows.join(F.broadcast(sample), F.col(keys[0]) == F.col("label_id"), "left")
    ratios = fit_ratios(marked, buckets)
    schema = ", ".join(f"`{n}` {t}" for n, t in marked.drop("text", "label_id").dtypes)
    scored = stage(
        marked.drop("label_id").select(*keys, "good", "text").mapInArrow(_scorer(ratios), f"{schema}, n_grams long, score double"), "scores"
    )
    fitted = scored.filter(F.col("good").isNotNull()).select("score", "good").limit(2 * fit_rows).toPandas()
    threshold = best_threshold(fitted["score"].to_numpy(float), fitted["good"].to_numpy(bool))
    wanted = scored.filter(F.col("score") >= F.lit(threshold)).count()
    bits = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]).bitwiseAND(F.lit(2**53 - 1))
    noise = -F.log(-F.log((bits.cast("double") + 0.5) / F.lit(float(2**53))))
    keyed = scored.withColumn("gumbel_key", F.col("score") / F.lit(temperature) + noise)
    ranked = with_rank(keyed, [], [F.col("gumbel_key").desc(), *keys], "rank")
    return ranked.select(*keys, "n_grams", "score", "gumbel_key", "rank", (F.col("rank") <= wanted).alias("selected"))


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op3_importance_resampling": op3_importance_resampling}
ORACLES: dict[str, str] = {}
