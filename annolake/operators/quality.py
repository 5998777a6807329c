"""PASS/FAIL rule tables and readiness reports, built from one-row aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolake.constants import SPLITS
from annolake.functions import boxes, names
from annolake.operators.annotate import lint_label_lines
from annolake.operators.profile import side_by_side
from annolake.operators.splits import split_bit
from annolake.session import broadcast_checked, stage


#: Offenders that a rule names.
EXAMPLES = 20


def rule(name: str, frame: DataFrame, passed: Column, details: Column) -> DataFrame:
    """One rule row from a one-row frame."""
    return frame.select(
        F.lit(name).alias("name"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        details.cast("string").alias("details"),
    )


def rule_table(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def readiness(rules: DataFrame) -> DataFrame:
    return rules.agg(
        F.count("*").alias("rules"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.every(F.col("status") == "PASS").alias("final_readiness"),
    )


def split_ratio_check(rows: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Shares of train and val against 0.8 and 0.1."""
    counted = rows.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("split") == name).alias(name) for name in SPLITS],
    )
    share = lambda name: F.when(F.col("total") > 0, F.col(name) / F.col("total")).otherwise(0.0)
    return counted.select(
        "total",
        *SPLITS,
        ((F.abs(share("train") - 0.8) < tolerance) & (F.abs(share("val") - 0.1) < tolerance)).alias("passed"),
    )


def shared_keys(rows: DataFrame, keys: dict[str, Column], split: str = "split") -> DataFrame:
    """``kind, key, pairs``: keys that more than one split has, and how many pairs of splits share each."""
    long = rows.select(
        F.col(split).alias("_split"),
        F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), value.alias("key")) for kind, value in keys.items()])),
    )
    n = F.bit_count("_splits")
    found = long.groupBy("kind", "key").agg(F.bit_or(split_bit(F.col("_split"))).alias("_splits"))
    return found.filter(n > 1).select("kind", "key", (n * (n - 1) / 2).cast("long").alias("pairs"))


def shared_between_splits(rows: DataFrame, keys: dict[str, Column], split: str = "split") -> DataFrame:
    """One row: per kind of key, how many pairs of splits share a key.  One shuffle for all kinds."""
    return shared_keys(rows, keys, split).agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("pairs"))), F.lit(0)).alias(kind) for kind in keys]
    )


def offender_summary(offenders: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """``rule, n, examples``: sum of ``weight`` and the first ``most`` examples in order, for ``rule, example, weight``.

    Each task keeps its first ``most`` per rule before the shuffle, however many offenders there are.
    """
    # Equal examples tie and may swap; they read the same.
    order = F.row_number().over(Window.partitionBy("rule").orderBy("example"))
    first = offenders.select("rule", "example").withColumn("nth", order).filter(F.col("nth") <= most)
    listed = first.groupBy("rule").agg(F.array_sort(F.collect_list("example")).alias("examples"))
    return offenders.groupBy("rule").agg(F.sum("weight").alias("n")).join(listed, "rule")


def validation_rules(
    manifest: DataFrame,
    files: DataFrame,
    label_lines: DataFrame,
    roundtrip: DataFrame,
    expected_rows: DataFrame,
    corrupt_images: DataFrame | None = None,
    config_texts: DataFrame | None = None,
    config_paths: DataFrame | None = None,
) -> DataFrame:
    """The twelve rules of a processed dataset: ``name, status, details`` (a map from text to text).

    ``manifest``: split, source_split, image_id, project_image_path, project_label_path.
    ``label_lines``: label_file, line_no, line.  ``roundtrip``: the one-row comparison of
    label text and source boxes.  ``expected_rows``: one-row frame ``n``, the usable source images, counted
    without the manifest.  ``corrupt_images``: path.  ``config_texts``: name, text.  ``config_paths``: path, what
    configurations refer to; each has to be among ``files``.  Rules with offenders give their number
    (``count``) and the first 20 of them (``examples``, one per line).
    """
    manifest = stage(manifest.select("split", "source_split", "image_id", "project_image_path", "project_label_path"), "manifest")
    present = files.select("path").distinct().withColumn("_there", F.lit(True))
    missing = lambda column, kind: F.when(F.col(f"_{kind}").isNull(), F.concat(F.lit(f"missing {kind}: "), column))
    absent = (
        manifest.join(present.withColumnsRenamed({"path": "project_image_path", "_there": "_image"}), "project_image_path", "left")
        .join(present.withColumnsRenamed({"path": "project_label_path", "_there": "_label"}), "project_label_path", "left")
        .select(F.explode(F.array_compact(F.array(missing("project_image_path", "image"), missing("project_label_path", "label")))).alias("example"))
        .select(F.explode(F.array(F.lit("manifest_paths_exist"), F.lit("label_format_and_ranges"))).alias("rule"), "example")
    )
    shared = shared_keys(
        manifest,
        {
            "no_image_source_key_leakage": names.identity_key(F.col("source_split"), F.col("image_id")),
            "no_project_image_path_leakage": F.lower("project_image_path"),
            "no_label_path_leakage": F.lower("project_label_path"),
        },
    )
    leaks = shared.select(F.col("kind").alias("rule"), F.col("key").alias("example"), F.col("pairs").alias("weight"))
    defects = lint_label_lines(label_lines, "processed").select(
        F.lit("label_format_and_ranges").alias("rule"),
        F.concat("label_file", F.lit(":"), F.col("line_no").cast("string"), F.lit(": "), "error").alias("example"),
    )
    found = [absent, defects]
    if corrupt_images is not None:
        found.append(corrupt_images.select(F.lit("all_usable_images_open").alias("rule"), F.col("path").alias("example")))
    if config_texts is not None:
        text = F.lower("text")
        bad = config_texts.filter(text.contains("path\\to") | text.contains("placeholder"))
        found.append(bad.select(F.lit("no_placeholder_paths").alias("rule"), F.col("name").cast("string").alias("example")))
    if config_paths is not None:
        lost = config_paths.select("path").join(present.select("path"), "path", "left_anti")
        found.append(lost.select(F.lit("dataset_yaml_paths_resolve").alias("rule"), F.col("path").alias("example")))
    counted = reduce(DataFrame.unionByName, [f.withColumn("weight", F.lit(1).cast("long")) for f in found]).unionByName(leaks)
    summary = offender_summary(stage(counted, "offenders"))
    # One row: at most twelve rules, each with at most 20 examples.
    by_rule = summary.agg(F.map_from_entries(F.collect_list(F.struct("rule", F.struct("n", "examples")))).alias("offenders"))

    failures = F.col("mismatches") + F.col("missing_lines") + F.col("extra_lines")
    one = side_by_side(
        by_rule, roundtrip.select(failures.alias("failures")), split_ratio_check(manifest), expected_rows.select(F.col("n").alias("expected"))
    )

    def offending(name: str, source: str | None = None) -> tuple[str, Column, Column]:
        entry = F.col("offenders")[source or name]
        n = F.coalesce(entry["n"], F.lit(0))
        shown = F.create_map(F.lit("count"), n.cast("string"), F.lit("examples"), F.array_join(F.coalesce(entry["examples"], F.array()), "\n"))
        return name, n == 0, shown

    texts = lambda *columns: F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])
    rules = [
        offending("no_image_source_key_leakage"),
        offending("no_project_image_path_leakage"),
        offending("no_label_path_leakage"),
        offending("manifest_paths_exist"),
        offending("label_format_and_ranges"),
        offending("dataset_yaml_paths_resolve"),
        offending("all_usable_images_open"),
        ("coco_to_yolo_reversible", F.col("failures") == 0, texts("failures")),
        ("split_ratios_close_to_80_10_10", F.col("passed"), texts("total", *SPLITS)),
        ("source_traceability_present", F.col("total") == F.col("expected"), texts("total", "expected")),
        offending("no_placeholder_paths"),
        offending("all_labels_belong_to_single_split", "no_label_path_leakage"),
    ]
    rows = [
        F.struct(F.lit(name).alias("name"), F.when(passed, "PASS").otherwise("FAIL").alias("status"), details.alias("details"))
        for name, passed, details in rules
    ]
    return one.select(F.inline(F.array(*rows)))


def smoke_rules(
    manifest: DataFrame, label_lines: DataFrame, files: DataFrame, expected: dict[str, int], class_count: DataFrame,
    expected_classes: int = 80,
) -> DataFrame:
    """The six rules of a small training subset.

    ``manifest``: split, source_image_path, image_name, label_path.
    """
    counts = manifest.agg(*[F.count_if(F.col("split") == s).alias(s) for s in expected])
    unlabelled = (
        manifest.select(F.col("label_path").alias("path"))
        .join(files.select("path"), "path", "left_anti")
        .agg(F.count("*").alias("n"))
    )
    label_errors = lint_label_lines(label_lines, "smoke").agg(F.count("*").alias("n"))
    overlap = shared_between_splits(manifest, {"sources": F.col("source_image_path"), "names": F.col("image_name")})
    return rule_table(
        *[
            rule(f"{split}_image_count", counts, F.col(split) == n, F.col(split))
            for split, n in expected.items()
        ],
        rule("every_image_has_label", unlabelled, F.col("n") == 0, F.col("n")),
        rule("label_format_and_ranges", label_errors, F.col("n") == 0, F.col("n")),
        rule("no_smoke_split_leakage", overlap, (F.col("sources") + F.col("names")) == 0,
             F.col("sources") + F.col("names")),
        rule("dataset_yaml_resolves", class_count, F.col("n") == expected_classes, F.col("n")),
    )


def extraction_rules(
    images: DataFrame, annotations: DataFrame, files: DataFrame, image_path: Column, bad_files: DataFrame
) -> DataFrame:
    """Per source split: images, annotations, missing and unreadable files, repeated names."""
    names_of = images.withColumn("path", image_path)
    missing = names_of.join(files.select("path"), "path", "left_anti").groupBy("source_split").agg(
        F.count("*").alias("missing_images")
    )
    corrupt = names_of.join(bad_files.select("path"), "path", "left_semi").groupBy("source_split").agg(
        F.count("*").alias("corrupt_images")
    )
    repeats = (
        images.groupBy("source_split", "file_name")
        .agg(F.count("*").alias("_n"))
        .groupBy("source_split")
        .agg(F.sum("_n").alias("images"), F.sum(F.col("_n") - 1).alias("duplicate_file_names"))
    )
    counted = annotations.groupBy("source_split").agg(F.count("*").alias("annotations"))
    joined = repeats
    for frame in (counted, missing, corrupt):
        joined = joined.join(frame, "source_split", "left")
    joined = joined.fillna(0)
    return joined.withColumn("valid", (F.col("missing_images") + F.col("corrupt_images")) == 0)


def compare_expected(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """``item, expected, actual, status`` for two (item, value) tables."""
    left = expected.select("item", F.col("value").cast("string").alias("expected"))
    right = actual.select("item", F.col("value").cast("string").alias("actual"))
    return left.join(right, "item", "full").withColumn(
        "status", F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS").otherwise("FAIL")
    )


def subset_verification(
    source: DataFrame, subset: DataFrame, files: DataFrame, label_lines: DataFrame, subset_size: int,
    source_size: int | None = None,
) -> DataFrame:
    """One row: sizes, repeats, missing files, labelled instances and pass/fail.

    ``source`` and ``subset``: path.  ``label_lines``: label_file (full path), line.
    """

    present = files.select("path").distinct()
    images = present.select("path", F.lit(True).alias("_image"))
    labels = present.select(F.col("path").alias("label_file"), F.lit(True).alias("_label"))
    lines = label_lines.filter(F.trim("line") != "").groupBy("label_file").agg(F.count("*").alias("_lines"))

    def inspect(paths: DataFrame, prefix: str) -> DataFrame:
        """Repeated paths are counted first, so each file is looked up once."""
        times = F.col("_times")
        checked = (
            paths.groupBy("path")
            .agg(F.count("*").alias("_times"))
            .withColumn("label_file", names.label_path(F.col("path")))
            .join(images, "path", "left")
            .join(labels, "label_file", "left")
            .join(lines, "label_file", "left")
        )
        total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("long")
        return checked.agg(
            total(times).alias(f"{prefix}line_count"),
            total(times - 1).alias(f"{prefix}duplicate_count"),
            total(F.when(F.col("_image").isNull(), times)).alias(f"{prefix}missing_image_count"),
            total(F.when(F.col("_label").isNull(), times)).alias(f"{prefix}missing_label_count"),
            total(F.when(F.col("_label"), times * F.col("_lines"))).alias(f"{prefix}labeled_instance_count"),
        )

    report = side_by_side(inspect(source, "source_"), inspect(subset, "subset_"))
    zero = F.lit(0)
    for prefix in ("source_", "subset_"):
        for item in ("duplicate_count", "missing_image_count", "missing_label_count"):
            zero = zero + F.col(f"{prefix}{item}")
    passed = (zero == 0) & (F.col("subset_line_count") == subset_size)
    if source_size is not None:
        passed = passed & (F.col("source_line_count") == source_size)
    return report.withColumn("verification_status", F.when(passed, "passed").otherwise("failed"))


def subset_annotation_outcomes(selected: DataFrame, images: DataFrame, annotations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Annotations of the selected images with ``outcome``, rounded clipped box and change flag."""
    keys = ["source_split", "image_id"]
    chosen = selected.select(*keys).distinct().join(images.select(*keys, "width", "height"), keys)
    lookup = mapping.select("category_id", F.lit(True).alias("_category"))
    joined = annotations.join(chosen, keys).join(broadcast_checked(lookup), "category_id", "left")
    xywh = [F.col(c) for c in ("x", "y", "w", "h")]
    no_box = xywh[0].isNull() | xywh[1].isNull() | xywh[2].isNull() | xywh[3].isNull()
    box = boxes.round_box(boxes.clip_box(*xywh, F.col("width"), F.col("height")))
    outcome = (
        F.when(F.coalesce(F.col("iscrowd"), F.lit(0)) != 0, "crowd")
        .when(F.col("_category").isNull() | no_box, "other")
        .when(box.isNull(), "invalid_box")
        .otherwise("selected")
    )
    changed = F.coalesce(boxes.box_changed(*xywh, box), F.lit(False))
    return joined.withColumn("box", box).withColumn("outcome", outcome).withColumn("clipped_flag", changed)


def subset_annotation_report(selected: DataFrame, images: DataFrame, annotations: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row of counters for a subset document.  ``selected``: source_split, image_id (nulls
    where the name did not parse)."""
    keys = ["source_split", "image_id"]
    selected = stage(selected.select(*keys), "selected")
    parsed = selected.filter("image_id is not null")
    rows = subset_annotation_outcomes(parsed, images, annotations, mapping)
    kept = F.col("outcome") == "selected"
    counters = rows.agg(
        F.count_if(kept).alias("selected_annotation_count"),
        F.count_if(F.col("outcome") == "crowd").alias("excluded_crowd_annotation_count"),
        F.count_if(F.col("outcome") == "invalid_box").alias("rejected_invalid_box_count"),
        F.count_if(F.col("outcome") == "other").alias("rejected_other_annotation_count"),
        F.count_if(kept & F.col("clipped_flag")).alias("clipped_box_count"),
        (F.count_if(kept) - F.count_distinct(F.when(kept, F.col("annotation_id")))).alias(
            "duplicate_annotation_id_count"
        ),
    )
    known = images.select(*keys).distinct()
    found = parsed.join(known, keys, "left_semi").agg(F.count("*").alias("selected_image_count"))
    unknown = parsed.join(known, keys, "left_anti").agg(F.count("*").alias("_unknown"))
    unparsed = selected.filter("image_id is null").agg(F.count("*").alias("_unparsed"))
    repeated = (
        parsed.groupBy("image_id")
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_image_id_count"))
    )
    classes = mapping.agg(F.count("*").alias("category_count"))
    report = side_by_side(counters, found, unknown, unparsed, repeated, classes)
    return report.withColumn("missing_image_mapping_count", F.col("_unknown") + F.col("_unparsed")).drop(
        "_unknown", "_unparsed"
    )


def evaluation_readiness(facts: DataFrame) -> DataFrame:
    """Three-way readiness from a one-row frame of facts.

    Needs: checkpoint_exists, yaml_exists, manifest_exists, yaml_train, yaml_val, yaml_test,
    manifest_name, usable_pairs, exact_subset_available.
    """
    name = F.lower("manifest_name")
    has_test = F.col("yaml_test").isNotNull() & (F.col("yaml_test") != "")

    def not_substituted(other: str) -> Column:
        return has_test & ~F.col("yaml_test").eqNullSafe(F.col(f"yaml_{other}")) & ~name.contains(other)

    issues = F.array_compact(
        F.array(
            F.when(~F.col("checkpoint_exists"), "Production checkpoint is missing."),
            F.when(~F.col("yaml_exists"), "Dataset YAML is missing."),
            F.when(~F.col("manifest_exists"), "Test manifest is missing."),
            F.when(F.col("manifest_exists") & (F.col("usable_pairs") == 0),
                   "Test manifest has no usable image/label pairs."),
        )
    )
    ready = F.size("blocking_issues") == 0
    return facts.withColumn("blocking_issues", issues).select(
        *facts.columns,
        not_substituted("val").alias("no_validation_data_substitution"),
        not_substituted("train").alias("no_training_data_substitution"),
        (name.contains("val") & ~name.contains("test")).alias("refused_validation_manifest"),
        F.array_join("blocking_issues", " ").alias("blocking_issues"),
        F.when(ready & F.col("exact_subset_available"), "ready_for_exact_2500_test_evaluation")
        .when(ready, "ready_for_full_project_test_evaluation_exact_2500_subset_missing")
        .otherwise("blocked")
        .alias("evaluation_readiness_status"),
    )


# Name parts and file kinds of a manifest candidate.
MANIFEST_TOKENS = "2500|2k|subset|test|manifest"
MANIFEST_SUFFIXES = ["csv", "txt", "json", "yaml", "yml"]


def manifest_candidates(lines: DataFrame, header_rows: int = 1) -> DataFrame:
    """Candidate manifests with their row counts.  ``lines``: path, line."""
    path = F.col("path")
    ending = names.extension(path)
    kept = lines.filter(
        ending.isin(*MANIFEST_SUFFIXES) & F.lower(names.basename(path)).rlike(MANIFEST_TOKENS)
    )
    filled = F.count_if(F.trim("line") != "")
    return kept.groupBy("path").agg(filled.alias("_filled")).select(
        "path",
        F.when(ending == "csv", F.greatest(F.col("_filled") - header_rows, F.lit(0)))
        .when(ending == "txt", F.col("_filled"))
        .alias("row_count"),
    )


def find_manifest_by_rows(candidates: DataFrame, rows: int) -> DataFrame:
    """First test manifest with exactly ``rows`` rows; one row, null path when there is none."""
    fits = (F.col("row_count") == rows) & F.lower(names.basename(F.col("path"))).contains("test")
    return candidates.agg(
        F.min(F.when(fits, F.col("path"))).alias("path"),
        F.coalesce(F.bool_or(fits), F.lit(False)).alias("available"),
        F.count("*").alias("candidate_files"),
    )


def artifact_inventory(expected: DataFrame, files: DataFrame, reason: str) -> DataFrame:
    """Expected artifacts with ``generated`` and the reason when one is absent."""
    present = files.select("path").distinct().withColumn("_there", F.lit(True))
    return expected.join(present, "path", "left").select(
        *expected.columns,
        F.col("_there").isNotNull().alias("generated"),
        F.when(F.col("_there").isNull(), reason).alias("reason"),
    )


def required_files_missing(required: DataFrame, files: DataFrame) -> DataFrame:
    return required.select("path").exceptAll(files.select("path").distinct())


def run_readiness(log_checks: DataFrame, has_learning_rates: DataFrame, dataset_ready: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Evidence flags of a training run and whether all of them hold.

    ``has_learning_rates``, ``dataset_ready``: one row, one boolean.  ``checkpoints``: name,
    exists, valid, weights_changed.
    """
    flags = [c for c in log_checks.columns if c != "line_count"]
    saved = checkpoints.agg(
        F.coalesce(F.bool_or((F.col("name") == "best") & F.col("exists")), F.lit(False)).alias("best_checkpoint_written"),
        F.coalesce(F.bool_or((F.col("name") == "last") & F.col("exists")), F.lit(False)).alias("last_checkpoint_written"),
        F.coalesce(F.bool_or("weights_changed"), F.lit(False)).alias("backward_and_optimizer_update_completed"),
        F.coalesce(F.every("valid"), F.lit(False)).alias("checkpoints_valid"),
    )
    one = side_by_side(
        log_checks.select(*flags),
        saved,
        has_learning_rates.toDF("learning_rate_scheduling_executed"),
        dataset_ready.toDF("dataset_ready"),
    ).withColumn("forward_pass_completed", F.col("box_loss_executed"))
    ready = reduce(lambda a, b: a & b, [F.col(c) for c in one.columns])
    return one.withColumn("full_training_readiness", ready)


def model_card(base: DataFrame, **documents: DataFrame | None) -> DataFrame:
    """One row that joins one-row documents to ``base``; a missing document adds nulls.

    Columns arrive as ``<document>_<column>``; a column listed by several documents is
    also offered once under its own name, the first non-null value winning.
    """
    packed = base
    offered: dict[str, list[Column]] = {}
    columns: list[Column] = []
    for label, frame in documents.items():
        if frame is None:
            continue
        packed = packed.withColumn(f"_{label}", frame.select(F.struct(*frame.columns).alias("s")).scalar())
        for name in frame.columns:
            value = F.col(f"_{label}.{name}")
            columns.append(value.alias(f"{label}_{name}"))
            offered.setdefault(name, []).append(value)
    columns += [F.coalesce(*values).alias(name) for name, values in offered.items() if len(values) > 1]
    return packed.select(*base.columns, *columns)
