"""Large JSON documents read and written by many tasks.

A document is one JSON value, yet its arrays hold nearly all its bytes.  Reading cuts the text at closing
braces, so Spark reads byte ranges of one file in many tasks.  Whether such a brace closes an element
follows from what stands before it: quotes and brackets are counted per range, the few sums per range
are added up, and inside a range a window carries them on.  Writing formats entries in order, many tasks
at a time, and a commit step joins the part files of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annolake.session import delete_folders, forget_shuffles, release, stage

_RANGE = ["file", "block"]
# Everything up to the first opening brace outside strings (possessive, so it never backtracks).
_GLUE = r'^(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+\{'
_SECTION = r'"((?:[^"\\]|\\.)*)"\s*:\s*\[\s*\{$'


def _count(text: Column, character: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))).cast("long")


def carried_on(rows: DataFrame, sums: dict[str, Column], last: dict[str, Column] | None = None) -> DataFrame:
    """Add what all earlier rows of a file come to: sums by name, and the newest value that is not null.

    Within a byte range a window does it (a range is as long as an input split at most); between ranges a table
    of one row per range.
    """
    last = last or {}
    totals = rows.groupBy(*_RANGE).agg(
        *[F.sum(value).alias(f"_{name}") for name, value in sums.items()],
        *[F.max_by(value, F.when(value.isNotNull(), F.col("id"))).alias(f"_{name}") for name, value in last.items()],
    )
    before = Window.partitionBy(*_RANGE).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        *_RANGE,
        *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_{name}") for name in sums],
        *[F.last(f"_{name}", ignorenulls=True).over(earlier).alias(f"_{name}") for name in last],
    )
    inner = rows.select(
        "*",
        *[F.coalesce(F.sum(value).over(before), F.lit(0)).alias(f"_in_{name}") for name, value in sums.items()],
        *[F.last(value, ignorenulls=True).over(before).alias(f"_in_{name}") for name, value in last.items()],
    )
    return inner.join(bases, _RANGE).select(
        *rows.columns,
        *[(F.col(f"_in_{name}") + F.col(f"_{name}")).alias(name) for name in sums],
        *[F.coalesce(f"_in_{name}", f"_{name}").alias(name) for name in last],
    )


def _closed(chunks: DataFrame, level: int) -> None:
    """Raise for a file that ends inside a string or a bracket, or has anything but space behind its end."""
    last = F.max_by(F.struct("value", "inside", "opened", "squares"), F.struct("block", "id"))
    ends = chunks.groupBy("file").agg(
        F.sum("quotes").alias("quotes"), F.sum(F.col("opened") - F.col("closed")).alias("curly"),
        F.sum("squares").alias("square"), F.sum("opened").alias("opened"), last.alias("last"),
    )
    # The text behind the last brace counts as closed by one more.
    trailing = (F.col("curly") == -1) & F.col("last.value").rlike(r"^[\s\]]+$")
    empty = (F.col("opened") == 0) & F.col("last.value").rlike(r"^\s*\[\s*\]\s*$") if level == 1 else F.lit(False)
    good = (F.col("quotes") % 2 == 0) & (F.col("square") == 0) & (((F.col("curly") == 0) & (F.col("opened") > 0)) | trailing | empty)
    broken = ends.filter(~good).select("file").limit(3).collect()
    if broken:
        raise ValueError(f"broken JSON document: {', '.join(r.file for r in broken)}")


def json_elements(spark: SparkSession, path: str | list[str], level: int = 2) -> DataFrame:
    """``file, section, element``: the text of every object in the arrays of the documents at ``path``.

    ``level`` 2 means arrays that are values of the document's keys (``section``), 1 that a document is itself an array
    (``section`` null).  A document that ends inside a string or bracket, or whose elements are not parted by
    single commas, is an error; only its very last brace may be missing unnoticed.  A file without any byte has no
    elements.  Objects inside elements and braces inside strings are kept; arrays of anything but objects give
    no elements.  Only an element has to fit into a task.  Byte ranges follow ``spark.sql.files.maxPartitionBytes``.
    """
    texts = spark.read.text(path, lineSep="}", recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    quoted = carried_on(texts.withColumn("quotes", _count(bare, '"')), {"quotes_before": F.col("quotes")})
    inside = F.col("quotes_before") % 2 == 1
    plain = F.regexp_replace(F.when(inside, F.concat(F.lit('"'), bare)).otherwise(bare), '"[^"]*+(?:"|$)', "")
    chunks = stage(
        quoted.withColumn("plain", plain).select(
            *texts.columns, "quotes", inside.alias("inside"), _count(F.col("plain"), "{").alias("opened"),
            (_count(F.col("plain"), "[") - _count(F.col("plain"), "]")).alias("squares"),
            ((F.col("quotes_before") + F.col("quotes")) % 2 == 0).cast("long").alias("closed"),
        ),
        "chunks",
    )
    forget_shuffles(spark)
    _closed(chunks, level)

    depths = carried_on(chunks, {"curly": F.col("opened") - F.col("closed"), "square": F.col("squares")})
    ends = (F.col("closed") == 1) & (F.col("curly") + F.col("opened") == level)
    marked = depths.select(
        *_RANGE, "id", "value", ends.alias("ends"), "curly",
        (ends & (F.col("square") + F.col("squares") == 1)).alias("element"),
    )
    # A group is what lies between two such ends; nearly always it is one chunk (a range's first one is not looked at).
    behind = F.lag("ends").over(Window.partitionBy(*_RANGE).orderBy("id"))
    grouped = stage(carried_on(marked.withColumn("behind", behind), {"group": F.col("ends").cast("long")}), "chunks")
    release(chunks)
    forget_shuffles(spark)
    alone = F.col("ends") & F.coalesce("behind", F.lit(False))
    whole = grouped.filter(alone).select(*_RANGE, "id", F.col("value").alias("text"), "curly", "element")
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("block", "id", "value"))), lambda p: p["value"])
    parts = (
        grouped.filter(~alone)
        .groupBy("file", "group")
        .agg(
            F.min_by(F.struct("block", "id", "curly"), F.struct("block", "id")).alias("head"),
            F.array_join(pieces, "}").alias("text"),
            F.bool_or("element").alias("element"),
        )
        .select("file", "head.block", "head.id", "text", "head.curly", "element")
    )
    # Where a document begins, its own brace comes before that of the first group.
    own = r"^\s*+\{" + _GLUE[1:]
    glue = F.when(F.col("curly") == level - 2, F.regexp_extract("text", own, 0)).otherwise(F.regexp_extract("text", _GLUE, 0))
    named = F.nullif(F.regexp_extract("glue", _SECTION, 1), F.lit(""))
    groups = whole.union(parts).filter("element").withColumn("glue", glue).withColumn("named", named)
    found = carried_on(groups, {}, {"carried": F.col("named")}) if level > 1 else groups.withColumn("carried", F.lit(None).cast("string"))
    body = F.concat(F.lit("{"), F.substr("text", F.length("glue") + 1), F.lit("}"))
    apart = F.col("glue").rlike(r"^\s*,\s*\{$") | (F.col("named").isNotNull() if level > 1 else F.col("glue").rlike(r"^\s*\[\s*\{$"))
    checked = F.when(apart, body).otherwise(F.raise_error(F.concat(F.lit("broken JSON document: "), F.col("file"))))
    elements = stage(found.select("file", F.coalesce("named", "carried").alias("section"), checked.alias("element")), "elements")
    release(grouped)
    forget_shuffles(spark)
    return elements


def section_rows(elements: DataFrame, section: str | None, schema: str, *keep: str) -> DataFrame:
    """Elements of one section as columns of ``schema``; text that does not fit the schema is an error."""
    some = elements if section is None else elements.filter(F.col("section") == section)
    return some.select(*keep, F.from_json("element", schema, {"mode": "FAILFAST"}).alias("e")).select(*keep, "e.*")


def write_json_documents(sections: dict[str, DataFrame], key: str, path: str, parts: int | None = None) -> None:
    """One loadable JSON document per value of ``key``, ``path/<value>.json``, with an array for each section.

    ``sections`` have ``key`` and ``e``, a struct.  Entries are ordered by their fields; equal entries are
    all kept.  A section that a key has no entries of is an empty array.

    Entries are range-partitioned in order and written as Spark text files below ``path/_parts`` (so a failed task
    writes its own file again), each behind a comma; the commit joins the files of each document in order without a
    section's first comma, so no entry has to know its number.  Repeating the call after a failure starts anew; a
    finished document is never left half written, as it gets its name last.
    """
    spark = next(iter(sections.values())).sparkSession
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    below = f"{path.rstrip('/')}/_parts"
    delete_folders(spark, {below})
    for number, rows in enumerate(sections.values()):
        ordered = rows.select(key, "e").repartitionByRange(count, key, "e").sortWithinPartitions(key, "e")
        entry = F.concat(F.lit(","), F.to_json("e", {"ignoreNullFields": "false"}))
        ordered.select(key, entry.alias("line")).write.partitionBy(key).text(f"{below}/{number}")
        forget_shuffles(spark)
    join_parts(spark, below, path, list(sections))


def join_parts(spark: SparkSession, parts: str, target: str, sections: list[str]) -> None:
    """Join the part files of each ``parts/<number of section>/<key>=<value>`` folder into ``target/<value>.json``, then drop ``parts``.

    A value stands in the file name as in the folder name, special characters escaped.  A file system that can
    concatenate reads only the first file of each section; any other copies file after file through a buffer, so
    memory does not grow with the document, and deletes what is copied, so a document is not on disk twice.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[list]] = {}
    for number in range(len(sections)):
        for folder in system.listStatus(path(parts, str(number))):
            if folder.isDirectory():
                value = folder.getPath().getName().split("=", 1)[1]
                files = [s.getPath() for s in system.listStatus(folder.getPath()) if s.getLen() and s.getPath().getName().startswith("part-")]
                found.setdefault(value, [[] for _ in sections])[number] = sorted(files, key=lambda p: p.getName())
    for value, files in found.items():
        # What comes before each file: the brackets around sections, behind which a file's first comma goes.
        pieces, closing = [], "{"
        for name, own in zip(sections, files, strict=True):
            opening = f'{closing}"{name}": [\n'
            pieces += [(opening, own[0]), *((None, one) for one in own[1:])] if own else [(opening, None)]
            closing = "],"
        pieces.append(("]}\n", None))
        hidden, final = path(target, f"_{value}.json.joining"), path(target, f"{value}.json")
        out = system.create(hidden, True)
        if system.getScheme() in ("hdfs", "webhdfs"):
            out.close()
            _concatenate(spark, system, hidden, path(parts), pieces)
        else:
            try:
                for before, one in pieces:
                    _copy(spark, system, out, before, one)
            finally:
                out.close()
        system.delete(final, False)
        if not system.rename(hidden, final):
            raise OSError(f"cannot name {final}")
    system.delete(path(parts), True)


def _copy(spark: SparkSession, system, out, before: str | None, one) -> None:
    """Write ``before`` and the file ``one`` to ``out``, behind ``before`` without its first byte, a comma; ``one`` is deleted."""
    if before is not None:
        out.write(bytearray(before.encode()))
    if one is None:
        return
    source = system.open(one)
    try:
        if before is not None and source.read() != ord(","):
            raise ValueError(f"not an entry: {one}")
        spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
    finally:
        source.close()
    system.delete(one, False)


def _concatenate(spark: SparkSession, system, target, parts, pieces: list) -> None:
    """Let the file system join ``pieces`` behind the empty ``target``; only those with text before them are copied."""
    path, files = spark._jvm.org.apache.hadoop.fs.Path, []
    for number, (before, one) in enumerate(pieces):
        if before is not None:
            head = path(parts, f"head-{number}")
            out = system.create(head, True)
            try:
                _copy(spark, system, out, before, one)
            finally:
                out.close()
            one = head
        files.append(one)
    sources = spark.sparkContext._gateway.new_array(path, len(files))
    for i, one in enumerate(files):
        sources[i] = one
    system.concat(target, sources)
