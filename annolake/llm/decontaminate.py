"""Benchmark decontamination over a distributed positional inverted index.

The index stores a posting (document, position, term) for every training word that a benchmark item uses; a
marker posting per document keeps its length.  A phrase is looked up from its rarest terms: their
lists, each moved back by the term's offset, are intersected, and what is left is compared word by
word with the document.  The same lists give proximity matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolake.llm.common import stage, table, text_or_empty
from annolake.llm.substring import LAST_ID, keyed_documents
from annolake.session import broadcast_checked

PHRASE = 10
#: Lists that are intersected before words are compared.
RAREST = 3
#: Everything but word characters, after A-Z became a-z.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The term of the marker that ends each document; no word is empty.
_END = ""


def words(text: Column) -> Column:
    """The words of ``text``; only A-Z change case."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), GAPS), lambda word: word != "")


def phrases(items: DataFrame, length: int = PHRASE) -> DataFrame:
    """``item, phrase, term_list`` per run of ``length`` words of each item; a shorter item is one phrase, one
    without words none.  ``phrase`` identifies equal lists."""
    split = items.select(F.col("item_id").cast("string").alias("item"), words(text_or_empty()).alias("_w"))
    count = F.size("_w")
    runs = F.when(
        count >= length, F.transform(F.sequence(F.lit(1), F.greatest(count - length + 1, F.lit(1))), lambda i: F.slice("_w", i, length))
    ).otherwise(F.when(count > 0, F.array("_w")).otherwise(F.array().cast("array<array<string>>")))
    return (
        split.select("item", F.explode(runs).alias("term_list"))
        .withColumn("phrase", F.xxhash64("term_list"))
        .distinct()
    )


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings ``id, key, place, term`` of ``docs`` for the words in ``terms`` (``word``), and one with
    the empty term at the place after the last word of each row.  Kept below the shared folder."""
    marked = F.concat(words(F.col("text")), F.array(F.lit(_END)))
    places = keyed_documents(docs).select("id", "key", F.posexplode(marked).alias("place", "term"))
    wanted = terms.select(F.col("word").alias("term")).union(docs.sparkSession.createDataFrame([(_END,)], "term string"))
    return stage(places.join(broadcast_checked(wanted.distinct()), "term").select("id", "key", "place", "term"), "postings")


def rarest_terms(index: DataFrame, phrase_table: DataFrame, rarest: int = RAREST) -> DataFrame:
    """``phrase, slot, offset, term, need, length``: the rarest places of each phrase that can occur.

    Phrases with a word that no document has are left out.
    """
    counts = index.groupBy("term").agg(F.count("*").alias("_n"))
    places = phrase_table.select("phrase", "term_list").distinct().select(
        "phrase", F.size("term_list").alias("length"), F.posexplode("term_list").alias("offset", "term")
    )
    known = places.join(counts, "term", "left")
    of_phrase = Window.partitionBy("phrase")
    return (
        known.withColumn("_known", F.count("_n").over(of_phrase))
        .filter("_known = length")
        .withColumn("slot", F.row_number().over(of_phrase.orderBy("_n", "term", "offset")) - 1)
        .filter(F.col("slot") < rarest)
        .select("phrase", "slot", "offset", "term", F.least("length", F.lit(rarest)).alias("need"), "length")
    )


def _moved_lists(index: DataFrame, rare: DataFrame) -> DataFrame:
    return index.join(broadcast_checked(rare), "term").withColumn("start", F.col("place") - F.col("offset"))


def phrase_matches(docs: DataFrame, index: DataFrame, phrase_table: DataFrame, rarest: int = RAREST) -> DataFrame:
    """``id, key, start, phrase, length`` of every exact occurrence of a phrase in ``docs``."""
    rare = stage(rarest_terms(index, phrase_table, rarest), "rarest")
    met = (
        _moved_lists(index, rare)
        .filter("start >= 0")
        .groupBy("id", "key", "start", "phrase", "need", "length")
        .agg(F.bit_or(F.expr("shiftleft(1, slot)")).alias("_slots"))
        .filter(F.col("_slots") == F.expr("shiftleft(1, need) - 1"))
    )
    listed = met.groupBy("id", "key").agg(F.collect_list(F.struct("start", "phrase", "length")).alias("_at"))
    texts = keyed_documents(docs).join(listed, ["id", "key"])
    split = texts.select("id", "key", "_at", words(F.col("text")).alias("_w"))
    slices = F.transform(
        "_at",
        lambda at: F.struct(
            at["start"].alias("start"),
            at["phrase"].alias("phrase"),
            at["length"].alias("length"),
            F.slice(F.col("_w"), at["start"] + 1, at["length"]).alias("term_list"),
        ),
    )
    shown = split.select("id", "key", F.inline(slices))
    exact = phrase_table.select("phrase", "term_list").distinct()
    return shown.join(broadcast_checked(exact), ["phrase", "term_list"]).select("id", "key", "start", "phrase", "length")


def proximity_matches(index: DataFrame, phrase_table: DataFrame, reach: int, rarest: int = RAREST) -> DataFrame:
    """``id, key, phrase`` where the rarest terms of a phrase lie, in any order, in one stretch of ``reach`` words.

    Every stretch of ``reach`` words lies in one of the half-overlapping blocks of twice that length; within
    a block the gap between the terms is taken from the list of places, which a block bounds.
    """
    rare = stage(rarest_terms(index, phrase_table, rarest), "rarest")
    block = F.floor(F.col("place") / reach)
    spread = _moved_lists(index, rare).select(
        "id", "key", "phrase", "need", "slot", "place", F.explode(F.array(block - 1, block)).alias("block")
    )
    grouped = spread.groupBy("id", "key", "phrase", "need", "block").agg(
        F.collect_set(F.struct("place", "slot")).alias("at"), F.bit_or(F.expr("shiftleft(1, slot)")).alias("slots")
    )
    full = grouped.filter(F.col("slots") == F.expr("shiftleft(1, need) - 1"))
    near = F.exists(
        "at",
        lambda first: F.size(
            F.array_distinct(
                F.transform(
                    F.filter("at", lambda other: (other["place"] >= first["place"]) & (other["place"] < first["place"] + reach)),
                    lambda other: other["slot"],
                )
            )
        )
        == F.col("need"),
    )
    return full.filter(near).select("id", "key", "phrase").distinct()


def contamination(docs: DataFrame, items: DataFrame, length: int = PHRASE, rarest: int = RAREST) -> DataFrame:
    """Per row of ``docs``: ``doc_id, key, n_words, n_hit, items`` (sorted ids of items with occurring phrases).

    A word is hit if an occurrence of a phrase covers it.  Null texts have no words, nor have null items
    or items without words phrases; a null item id is never reported, though its phrases hit.  Repeated rows
    each get the same result.  Other columns are not read; empty tables give no rows or no
    hits.  Broadcast are only tables made from the benchmark, after their rows were counted; larger ones are
    shuffled.
    """
    table_ = stage(phrases(items, length), "phrases")
    terms = table_.select(F.explode("term_list").alias("word")).distinct()
    index = build_index(docs, terms)
    found = stage(phrase_matches(docs, index, table_, rarest), "matches")
    covered = found.select("id", "key", "start", "length").distinct().select(
        "id", "key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("place")
    )
    hits = covered.distinct().groupBy("id", "key").agg(F.count("*").alias("n_hit"))
    named = (
        found.select("id", "key", "phrase")
        .distinct()
        .join(broadcast_checked(table_.select("phrase", "item").distinct()), "phrase")
        .groupBy("id", "key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    whole = index.filter(F.col("term") == _END).select("id", "key", F.col("place").cast("long").alias("n_words"))
    return (
        whole.join(hits.join(named, ["id", "key"]), ["id", "key"], "left")
        .select(
            F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"),
            "key",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def op7_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), p AS (
  SELECT DISTINCT item, array_to_string(list_slice(words, s + 1, s + least(len(words), 10)), ' ') AS phrase,
         least(len(words), 10) AS n
  FROM (SELECT item, words, unnest(range(0, greatest(len(words) - 9, 1))) AS s FROM b WHERE len(words) > 0)
), g AS (
  SELECT doc_id, s, n, array_to_string(list_slice(words, s + 1, s + n), ' ') AS phrase
  FROM (
    SELECT doc_id, words, n, unnest(range(0, len(words) - n + 1)) AS s
    FROM w, (SELECT DISTINCT n FROM p) WHERE len(words) >= n
  )
), m AS (
  SELECT g.doc_id, g.s, g.n, p.item FROM g JOIN p ON g.phrase = p.phrase AND g.n = p.n
), h AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM (SELECT DISTINCT doc_id, s, n FROM m)) GROUP BY 1
), i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY 1
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h ON h.doc_id = w.doc_id LEFT JOIN i ON i.doc_id = w.doc_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op7_positional_index": op7_positional_index}
ORACLES: dict[str, str] = {"op7_positional_index": ORACLE}
