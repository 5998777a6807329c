"""The same results in DuckDB SQL over the driver tables.

``PARTS`` are shared common table expressions; a query pulls in those it names.
"""

from __future__ import annotations

import re

from annolake.plans.fixtures import BASE_TABLES, VIEWS

PARTS: dict[str, str] = {
    name: text.format(**{n: n for n in (*BASE_TABLES, *VIEWS)}) for name, text in VIEWS.items()
}

PARTS["mapping"] = "SELECT *, row_number() OVER (ORDER BY category_id) - 1 AS class_id FROM fx_categories"

PARTS["boxed"] = """
SELECT a.*, i.file_name, i.width, i.height,
  CASE WHEN w IS NOT NULL AND least(width::DOUBLE, x + w) > greatest(0::DOUBLE, x) AND least(height::DOUBLE, y + h) > greatest(0::DOUBLE, y) THEN 1 ELSE 0 END AS inside,
  greatest(0::DOUBLE, x) AS bx, greatest(0::DOUBLE, y) AS by_,
  least(width::DOUBLE, x + w) - greatest(0::DOUBLE, x) AS bw, least(height::DOUBLE, y + h) - greatest(0::DOUBLE, y) AS bh
FROM fx_annotations a JOIN fx_images i USING (source_split, image_id)"""

PARTS["reasoned"] = """
SELECT b.*, m.name AS category_name, m.class_id,
  CASE WHEN iscrowd <> 0 THEN 'iscrowd_excluded_for_yolov5_compatibility'
       WHEN width <= 0 OR height <= 0 THEN 'missing_image_or_invalid_dimensions'
       WHEN m.class_id IS NULL THEN 'invalid_category_id'
       WHEN w IS NULL THEN 'missing_bbox'
       WHEN inside = 0 THEN 'invalid_bbox:bbox has zero or negative area after clipping'
       ELSE '' END AS reason
FROM boxed b LEFT JOIN mapping m USING (category_id)"""

PARTS["classified"] = """
SELECT *, CASE WHEN iscrowd <> 0 THEN 'excluded' WHEN reason = '' THEN 'accepted' ELSE 'rejected' END AS status FROM reasoned"""

PARTS["accepted"] = """
SELECT *, (bx + bw / 2) / width AS yxc, (by_ + bh / 2) / height AS yyc, bw / width AS yw, bh / height AS yh
FROM classified WHERE status = 'accepted'"""

PARTS["rollup"] = """
SELECT concat(i.source_split, '_', i.image_id) AS internal_record_id, i.source_split, i.image_id, i.file_name, i.width, i.height,
  coalesce(n, 0) AS valid_object_count, coalesce(array_to_string([CAST(z AS VARCHAR) for z in ids], '|'), '') AS category_ids,
  coalesce(array_to_string(nms, '|'), '') AS category_names, coalesce(nms, []) AS name_list,
  coalesce(crowd, false) AS has_crowd_annotations, i.width > 0 AND i.height > 0 AS usable_for_training
FROM fx_images i LEFT JOIN (
  SELECT source_split, image_id, count(*) FILTER (status = 'accepted') AS n,
    list_sort(list_distinct(list(category_id) FILTER (status = 'accepted'))) AS ids,
    list_sort(list_distinct(list(category_name) FILTER (status = 'accepted'))) AS nms,
    bool_or(status = 'excluded') AS crowd
  FROM classified GROUP BY source_split, image_id) r USING (source_split, image_id)"""

PARTS["usable"] = """
SELECT *, concat(source_split, '_', image_id) AS internal_record_id FROM fx_images WHERE width > 0 AND height > 0"""

PARTS["splits"] = """
SELECT * EXCLUDE (rk, n), CASE WHEN rk <= floor(n * 0.8::DOUBLE) THEN 'train'
  WHEN rk <= floor(n * 0.8::DOUBLE) + floor(n * 0.1::DOUBLE) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || internal_record_id), internal_record_id) AS rk,
  CAST(count(*) OVER () AS DOUBLE) AS n FROM usable)"""

PARTS["leaky"] = """
SELECT * FROM splits UNION ALL
SELECT * REPLACE ('test' AS split) FROM splits WHERE image_id % 50 = 0 AND split <> 'test'"""

PARTS["manifest"] = """
SELECT s.*, r.valid_object_count, r.category_names, r.name_list,
  concat('raw/', s.source_split, '/', s.file_name) AS source_image_path,
  concat('images/', s.source_split, '_', s.file_name) AS project_image_path,
  concat('labels/', s.source_split, '_', replace(s.file_name, '.jpg', '.txt')) AS project_label_path
FROM splits s JOIN rollup r USING (source_split, image_id)"""

PARTS["paths"] = """
SELECT source_split, image_id, concat('images/', source_split, '_', file_name) AS image_path,
  concat('labels/', source_split, '_', replace(file_name, '.jpg', '.txt')) AS label_path FROM fx_images"""

PARTS["label_values"] = """
SELECT label_file, line_no, line, string_split(line, ' ') AS p,
  CAST(TRY_CAST(string_split(line, ' ')[1] AS DOUBLE) AS BIGINT) AS class_id, TRY_CAST(string_split(line, ' ')[2] AS DOUBLE) AS xc,
  TRY_CAST(string_split(line, ' ')[3] AS DOUBLE) AS yc, TRY_CAST(string_split(line, ' ')[4] AS DOUBLE) AS w, TRY_CAST(string_split(line, ' ')[5] AS DOUBLE) AS h
FROM fx_label_lines"""


def _lint(upper: str) -> str:
    return f"""
SELECT label_file, line_no, error FROM (
  SELECT label_file, line_no, unnest([
    CASE WHEN len(p) <> 5 THEN 'field_count' END,
    CASE WHEN len(p) = 5 AND NOT num THEN 'non_numeric' END,
    CASE WHEN len(p) = 5 AND num AND (class_id < 0 {upper}) THEN 'class_out_of_range' END,
    CASE WHEN len(p) = 5 AND num AND NOT (xc BETWEEN 0 AND 1 AND yc BETWEEN 0 AND 1 AND w BETWEEN 0 AND 1 AND h BETWEEN 0 AND 1) THEN 'value_out_of_range' END,
    CASE WHEN len(p) = 5 AND num AND (w <= 0 OR h <= 0) THEN 'non_positive_size' END]) AS error
  FROM (SELECT *, class_id IS NOT NULL AND xc IS NOT NULL AND yc IS NOT NULL AND w IS NOT NULL AND h IS NOT NULL AS num FROM label_values))
WHERE error IS NOT NULL"""


PARTS["lint79"] = _lint("OR class_id > 79")

PARTS["numbered"] = """
SELECT source_split, image_id, row_number() OVER (PARTITION BY source_split, image_id ORDER BY annotation_id, class_id, yxc, yyc, yw, yh) AS pos,
  class_id, yxc AS xc, yyc AS yc, yw AS w, yh AS h FROM accepted"""

PARTS["conversions"] = """
SELECT p.det_id, p.numeric_id AS image_id, CAST(p.class_id AS BIGINT) AS class_id, m.category_id,
  round(p.x, 3) AS x, round(p.y, 3) AS y, round(p.w, 3) AS w, round(p.h, 3) AS h, round(p.score, 5) AS score,
  CASE WHEN i.image_id IS NULL THEN 'dropped_unknown_image' WHEN m.category_id IS NULL THEN 'dropped_unknown_category'
       WHEN p.w <= 0 OR p.h <= 0 THEN 'dropped_invalid_bbox' ELSE 'converted' END AS outcome
FROM (SELECT *, CASE WHEN regexp_matches(image_id, '^[0-9]+$') THEN TRY_CAST(image_id AS BIGINT)
        ELSE TRY_CAST(nullif(regexp_extract(image_id, '^(train2017|val2017)_([0-9]{12})$', 2), '') AS BIGINT) END AS numeric_id FROM fx_predictions) p
LEFT JOIN fx_images i ON i.image_id = p.numeric_id LEFT JOIN mapping m ON m.class_id = p.class_id"""

PARTS["converted"] = "SELECT * EXCLUDE (outcome) FROM conversions WHERE outcome = 'converted'"

PARTS["gt"] = """
SELECT image_id, class_id, annotation_id AS gt_id, round(bx, 3) AS x, round(by_, 3) AS y, round(bw, 3) AS w, round(bh, 3) AS h,
  round(round(bw, 3) * round(bh, 3), 3) AS area FROM accepted"""

PARTS["ranked"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, class_id ORDER BY score DESC, det_id) AS rk FROM converted) WHERE rk <= 100"""

PARTS["box_pairs"] = """
SELECT * FROM (SELECT image_id, class_id, rk, det_id, gt_id, area, ow * oh / (dw * dh + gw * gh - ow * oh) AS iou
  FROM (SELECT r.image_id, r.class_id, r.rk, r.det_id, g.gt_id, g.area, r.w AS dw, r.h AS dh, g.w AS gw, g.h AS gh,
      least(r.x + r.w, g.x + g.w) - greatest(r.x, g.x) AS ow, least(r.y + r.h, g.y + g.h) - greatest(r.y, g.y) AS oh
    FROM ranked r JOIN gt g USING (image_id, class_id)) WHERE ow > 0 AND oh > 0) WHERE iou >= 0.5"""

PARTS["candidates"] = """
SELECT *, row_number() OVER (PARTITION BY image_id, class_id ORDER BY rk) AS step FROM (
  SELECT image_id, class_id, rk, det_id, list({'iou': iou, 'gt_id': gt_id, 'area': area}) AS cands FROM box_pairs GROUP BY ALL)"""

PARTS["ranges"] = """
SELECT * FROM (VALUES (0, 0::DOUBLE, 1e10::DOUBLE), (1, 0::DOUBLE, 1024::DOUBLE), (2, 1024::DOUBLE, 9216::DOUBLE), (3, 9216::DOUBLE, 1e10::DOUBLE)) v(area_no, lo, hi)"""

PARTS["thresholds"] = """
SELECT * FROM (VALUES (0, 0.5::DOUBLE), (1, 0.55::DOUBLE), (2, 0.6::DOUBLE), (3, 0.65::DOUBLE), (4, 0.7::DOUBLE), (5, 0.75::DOUBLE), (6, 0.8::DOUBLE), (7, 0.85::DOUBLE), (8, 0.9::DOUBLE), (9, 0.95::DOUBLE)) v(t, threshold)"""

# Recursive walk down the detections of an image and class, remembering the used boxes.
PARTS["walk"] = """
  SELECT image_id, class_id, area_no, t, lo, hi, threshold, CAST(0 AS BIGINT) AS step, CAST(0 AS BIGINT) AS rk, CAST(0 AS BIGINT) AS det_id,
    CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS gt_id, false AS counts
  FROM (SELECT DISTINCT image_id, class_id FROM candidates) CROSS JOIN ranges CROSS JOIN thresholds
  UNION ALL
  SELECT image_id, class_id, area_no, t, lo, hi, threshold, step, rk, det_id,
    CASE WHEN best IS NULL THEN used ELSE list_append(used, best.gt_id) END, best.gt_id, coalesce(best.ok, false)
  FROM (SELECT m.image_id, m.class_id, m.area_no, m.t, m.lo, m.hi, m.threshold, c.step, c.rk, c.det_id, m.used,
      list_sort([{'ok': z.area BETWEEN m.lo AND m.hi, 'iou': z.iou, 'gt_id': z.gt_id} for z in c.cands
        if z.iou >= least(m.threshold, 1 - 1e-10) and not list_contains(m.used, z.gt_id)], 'DESC')[1] AS best
    FROM walk m JOIN candidates c ON c.image_id = m.image_id AND c.class_id = m.class_id AND c.step = m.step + 1)"""

PARTS["matches"] = "SELECT image_id, class_id, area_no, t, rk, det_id, gt_id, counts FROM walk WHERE gt_id IS NOT NULL"

# Detection by area range and threshold: hit, miss or out of the game.
PARTS["judged"] = """
SELECT r.class_id, r.image_id, r.det_id, r.rk, r.score, a.area_no, h.t, coalesce(m.counts, false) AS hit
FROM ranked r CROSS JOIN ranges a CROSS JOIN thresholds h
LEFT JOIN matches m ON m.image_id = r.image_id AND m.class_id = r.class_id AND m.rk = r.rk AND m.area_no = a.area_no AND m.t = h.t
WHERE CASE WHEN m.gt_id IS NULL THEN r.w * r.h BETWEEN a.lo AND a.hi ELSE m.counts END"""

PARTS["cumulated"] = """
SELECT *, sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER o AS tp, count(*) OVER o AS n FROM judged
WINDOW o AS (PARTITION BY class_id, area_no, t ORDER BY score DESC, image_id, rk ROWS UNBOUNDED PRECEDING)"""

PARTS["positives"] = "SELECT class_id, area_no, count(*) AS npig FROM gt JOIN ranges ON area BETWEEN lo AND hi GROUP BY ALL"

PARTS["curve"] = """
SELECT c.*, npig, c.tp / npig AS rc, max(c.tp / c.n) OVER (PARTITION BY c.class_id, c.area_no, c.t ORDER BY score DESC, image_id, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS env
FROM (SELECT class_id, area_no, t, score, image_id, rk, det_id, hit, CAST(tp AS DOUBLE) AS tp, CAST(n AS DOUBLE) AS n FROM cumulated) c JOIN positives USING (class_id, area_no)"""

PARTS["steps"] = """
SELECT *, coalesce(lag(rc) OVER (PARTITION BY class_id, area_no, t ORDER BY rc), -1) AS before FROM (
  SELECT class_id, area_no, t, rc, max(env) AS env FROM curve WHERE hit GROUP BY ALL)"""

PARTS["recall_points"] = "SELECT i * 0.01::DOUBLE AS r FROM range(0, 101) v(i)"

PARTS["average_precision"] = """
SELECT p.class_id, p.area_no, h.t, p.npig, coalesce(s.total, 0) / 101 AS ap,
  coalesce(q.tp, 0) / p.npig AS recall, coalesce(q.tp1, 0) / p.npig AS recall_1, coalesce(q.tp10, 0) / p.npig AS recall_10
FROM positives p CROSS JOIN thresholds h
LEFT JOIN (SELECT class_id, area_no, t, sum(env) AS total FROM steps JOIN recall_points ON r > before AND r <= rc GROUP BY ALL) s USING (class_id, area_no, t)
LEFT JOIN (SELECT class_id, area_no, t, count(*) FILTER (counts) AS tp, count(*) FILTER (counts AND rk <= 1) AS tp1, count(*) FILTER (counts AND rk <= 10) AS tp10
  FROM matches GROUP BY ALL) q USING (class_id, area_no, t)"""

PARTS["summary"] = """
SELECT metric, round(coalesce(value, -1), 6) AS value FROM (
  SELECT 'AP@[0.50:0.95]' AS metric, avg(ap) AS value FROM average_precision WHERE area_no = 0
  UNION ALL SELECT 'AP@0.50', avg(ap) FROM average_precision WHERE area_no = 0 AND t = 0
  UNION ALL SELECT 'AP@0.75', avg(ap) FROM average_precision WHERE area_no = 0 AND t = 5
  UNION ALL SELECT 'AP small', avg(ap) FROM average_precision WHERE area_no = 1
  UNION ALL SELECT 'AP medium', avg(ap) FROM average_precision WHERE area_no = 2
  UNION ALL SELECT 'AP large', avg(ap) FROM average_precision WHERE area_no = 3
  UNION ALL SELECT 'AR maxDets=1', avg(recall_1) FROM average_precision WHERE area_no = 0
  UNION ALL SELECT 'AR maxDets=10', avg(recall_10) FROM average_precision WHERE area_no = 0
  UNION ALL SELECT 'AR maxDets=100', avg(recall) FROM average_precision WHERE area_no = 0
  UNION ALL SELECT 'AR small', avg(recall) FROM average_precision WHERE area_no = 1
  UNION ALL SELECT 'AR medium', avg(recall) FROM average_precision WHERE area_no = 2
  UNION ALL SELECT 'AR large', avg(recall) FROM average_precision WHERE area_no = 3)"""

PARTS["levels"] = """
SELECT g.class_id, g.images, g.instances, b.bucket,
  (SELECT count(*) FROM cumulated c WHERE c.area_no = 0 AND c.t = 0 AND c.class_id = g.class_id AND floor(c.score * 1000) >= b.bucket) AS d,
  (SELECT count(*) FROM cumulated c WHERE c.area_no = 0 AND c.t = 0 AND c.class_id = g.class_id AND hit AND floor(c.score * 1000) >= b.bucket) AS tp
FROM (SELECT class_id, count(DISTINCT image_id) AS images, count(*) AS instances FROM gt GROUP BY ALL) g CROSS JOIN range(0, 1000) b(bucket)"""

PARTS["best_bucket"] = """
SELECT bucket FROM (SELECT bucket, round(avg(CASE WHEN tp > 0 THEN 2 * tp / (d + instances) ELSE 0 END), 9) AS f1 FROM levels GROUP BY bucket)
ORDER BY f1 DESC, bucket LIMIT 1"""

PARTS["class_report"] = """
SELECT m.name AS class_name, l.images, l.instances, round(CASE WHEN d > 0 THEN tp / d ELSE 0 END, 6) AS precision, round(tp / l.instances, 6) AS recall,
  round(a.ap50, 6) AS map50, round(a.ap, 6) AS map50_95
FROM levels l JOIN best_bucket USING (bucket) JOIN mapping m USING (class_id)
JOIN (SELECT class_id, max(ap) FILTER (t = 0) AS ap50, avg(ap) AS ap FROM average_precision WHERE area_no = 0 GROUP BY ALL) a USING (class_id)"""

PARTS["paced"] = """
SELECT *, CASE WHEN frame_index > 0 THEN CASE WHEN us > prev THEN 1 / ((us - prev) / 1000000::DOUBLE) ELSE 0 END END AS rate FROM (
  SELECT source_id, event_id, epoch_us(frame_ts) AS us, row_number() OVER f - 1 AS frame_index, lag(epoch_us(frame_ts)) OVER f AS prev
  FROM fx_frames WINDOW f AS (PARTITION BY source_id ORDER BY frame_ts, event_id))"""

PARTS["rates"] = """
SELECT source_id, event_id, frame_index, round(coalesce(rate, 0), 9) AS instantaneous_fps,
  round(coalesce(avg(rate) OVER (PARTITION BY source_id ORDER BY frame_index ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0), 9) AS moving_average_fps FROM paced"""

PARTS["frame_counts"] = """
SELECT source_id, string_agg(class_name || ':' || n, ',' ORDER BY class_name) AS class_counts FROM (
  SELECT source_id, class_name, sum(detection_count) AS n FROM fx_frames WHERE detection_count > 0 GROUP BY ALL) GROUP BY source_id"""

PARTS["videos"] = """
SELECT f.source_id, count(*) AS processed_frames, CAST(sum(detection_count) AS BIGINT) AS total_detections,
  round(avg(detection_count), 9) AS average_detections_per_frame, round(avg(inference_ms), 9) AS average_inference_time_ms,
  round(CASE WHEN sum(inference_ms) > 0 THEN count(*) / (sum(inference_ms) / 1000) ELSE 0 END, 9) AS average_processing_fps, any_value(c.class_counts) AS class_counts
FROM fx_frames f LEFT JOIN frame_counts c USING (source_id) GROUP BY f.source_id"""

PARTS["train_log"] = """
SELECT event_id, concat(['Transferred 342/349 items from weights', 'Model summary: 157 layers, 7225885 parameters', 'train: Scanning labels 32 images',
  'val: Scanning labels 16 images', 'epoch box_loss obj_loss cls_loss', 'optimizer: SGD(lr=0.01)', 'Validating best weights',
  'Optimizer stripped from last.pt', 'FutureWarning: call is deprecated', 'plain progress line'][event_id % 10 + 1], ' ', event_id) AS line FROM events"""

PARTS["log_flags"] = """
SELECT bool_or(contains(line, 'Transferred ')) AND bool_or(contains(line, 'items from')) AS pretrained_weights_loaded,
  bool_or(contains(line, 'Model summary:')) OR bool_or(contains(line, 'YOLOv5s summary:')) AS model_architecture_initialized,
  bool_or(contains(line, 'train: ')) AND bool_or(contains(line, '32 images')) AS training_images_discovered,
  bool_or(contains(line, 'val: ')) AND bool_or(contains(line, '16 images')) AS validation_images_discovered,
  bool_or(contains(line, 'box_loss')) AS box_loss_executed, bool_or(contains(line, 'obj_loss')) AS objectness_loss_executed,
  bool_or(contains(line, 'cls_loss')) AS classification_loss_executed,
  bool_or(contains(line, 'optimizer:')) AND bool_or(contains(line, 'SGD')) AS optimizer_configured,
  bool_or(contains(line, 'Validating ')) OR bool_or(contains(line, 'Class     Images')) AS validation_completed,
  bool_or(contains(line, 'Optimizer stripped from')) AND bool_or(contains(line, 'last.pt')) AS checkpoint_logged, count(*) AS line_count
FROM train_log"""

PARTS["archive_paths"] = """
SELECT page_id, concat(['', '/', 'data/raw/', 'a/../', 'models/trained/', 'data/set/', 'src\\__pycache__\\', 'outputs/videos/'][page_id % 8 + 1],
  regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1), ['', '.pt', '.jpg', '.cache', '.PTH'][page_id % 5 + 1]) AS path, CAST(length(html) AS BIGINT) AS size_bytes FROM pages"""

PARTS["archive_flags"] = """
SELECT page_id, size_bytes, starts_with(p, '/') AS absolute_path, regexp_matches(p, '(^|/)\\.\\.(/|$)') AS path_traversal,
  p GLOB '.venv/*' OR p GLOB 'data/raw/*' OR p GLOB 'data/processed/coco_yolo/images/*' OR p GLOB 'data/processed/coco_yolo/labels/*' OR p GLOB 'data/smoke/*'
    OR p GLOB 'external/yolov5/.git/*' OR p GLOB 'models/pretrained/*.pt' OR p GLOB 'models/trained/*' OR p GLOB 'models/optimized/*' OR p GLOB 'outputs/videos/*'
    OR p GLOB 'outputs/webcam/*' OR p GLOB 'results/yolov5s/smoke_test/*' OR regexp_matches(p, '^.*.*/__pycache__/.*$') OR regexp_matches(p, '^.*/.*\\.cache$') OR regexp_matches(p, '^.*/\\.pytest_cache/.*$') AS prohibited,
  regexp_matches(lower(p), '\\.(pt|pth)$') AS model_file, regexp_matches(lower(p), '\\.(jpg|jpeg|png|mp4|avi)$') AND starts_with(p, 'data/') AS dataset_media
FROM (SELECT *, replace(path, '\\', '/') AS p FROM archive_paths)"""

PARTS["fourcc"] = """
SELECT event_id, CASE WHEN event_id % 11 = 0 THEN '' ELSE concat(chr(CAST(97 + event_id % 26 AS INT)), 'vc', CASE WHEN event_id % 4 = 0 THEN '' ELSE '1' END) END AS codec FROM events"""

PARTS["listing"] = """
SELECT path, CASE WHEN ends_with(path, '.csv') THEN greatest(filled - 1, 0) ELSE filled END AS row_count FROM (
  SELECT concat('data/', o_custkey, '_', ['test_subset.csv', 'train.txt', 'notes.md', 'manifest_2500.txt', 'test_images.txt'][o_custkey % 5 + 1]) AS path,
    count(*) FILTER (o_orderkey % 9 <> 0) AS filled FROM orders GROUP BY 1)
WHERE NOT ends_with(path, '.md') AND (contains(path, 'test') OR contains(path, 'manifest'))"""

PARTS["rebuilt"] = """
SELECT split, counter, count(*) AS value FROM (
  SELECT s.split, CASE WHEN iscrowd <> 0 THEN 'excluded_crowd_annotations' WHEN class_id IS NULL THEN 'rejected_annotations'
    WHEN inside = 0 THEN 'rejected_invalid_boxes' ELSE 'accepted_annotations' END AS counter
  FROM reasoned r JOIN splits s USING (source_split, image_id)) GROUP BY ALL
UNION ALL SELECT split, 'image_count', count(*) FROM splits GROUP BY ALL
UNION ALL SELECT split, 'missing_images', 0 FROM splits GROUP BY ALL"""

PARTS["rebuilt_totals"] = """
SELECT counter, CAST(sum(value) AS BIGINT) AS value FROM rebuilt GROUP BY counter
UNION ALL SELECT 'class_count', count(*) FROM mapping"""

PARTS["availability"] = """
SELECT count(*) AS rows, count(i.path) AS image_exists, count(l.path) AS label_exists,
  count(*) FILTER (i.path IS NOT NULL AND l.path IS NOT NULL) AS usable_image_label_pairs, CAST(sum(valid_object_count) AS BIGINT) AS instances
FROM paths p JOIN rollup r USING (source_split, image_id) LEFT JOIN fx_files i ON i.path = p.image_path LEFT JOIN fx_files l ON l.path = p.label_path"""

# Diverse picks: per round the record that adds most unseen categories.
PARTS["pool"] = """
SELECT split, internal_record_id, valid_object_count, name_list AS nl, category_names, md5('42:' || internal_record_id) AS hs,
  CASE split WHEN 'train' THEN 32 ELSE 16 END AS want FROM manifest WHERE valid_object_count > 0 AND split IN ('train', 'val')"""

PARTS["reduced"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split, category_names ORDER BY valid_object_count DESC, hs, internal_record_id) AS nth FROM pool) WHERE nth <= want"""

PARTS["picks"] = """
  SELECT split, CAST(0 AS BIGINT) AS pick, want, CAST([] AS VARCHAR[]) AS seen, CAST([] AS VARCHAR[]) AS taken, CAST('' AS VARCHAR) AS internal_record_id
  FROM (SELECT DISTINCT split, want FROM reduced)
  UNION ALL
  SELECT split, pick + 1, want, list_distinct(list_concat(seen, best.nl)), list_append(taken, best.id), best.id FROM (
    SELECT k.split, k.pick, k.want, k.seen, k.taken,
      arg_min({'id': r.internal_record_id, 'nl': r.nl},
        {'a': -len([z for z in r.nl if NOT list_contains(k.seen, z)]), 'b': -len(r.nl), 'c': -r.valid_object_count, 'd': r.hs, 'e': r.internal_record_id}) AS best
    FROM picks k JOIN reduced r ON r.split = k.split AND NOT list_contains(k.taken, r.internal_record_id)
    WHERE k.pick < k.want GROUP BY ALL)"""

PARTS["chosen"] = """
SELECT p.split, p.pick, p.internal_record_id, m.source_split, m.image_id, m.valid_object_count, m.category_names,
  concat('train2017_', lpad(CAST(m.image_id AS STRING), 12, '0'), '.txt') AS label_file
FROM picks p JOIN manifest m USING (internal_record_id) WHERE p.pick > 0"""

PARTS["line_counts"] = "SELECT label_file, count(*) AS label_lines, count(DISTINCT class_id) AS classes FROM label_values GROUP BY label_file"

PARTS["absent"] = """
SELECT 'missing image: ' || project_image_path AS example FROM manifest WHERE project_image_path NOT IN (SELECT path FROM fx_files)
UNION ALL SELECT 'missing label: ' || project_label_path FROM manifest WHERE project_label_path NOT IN (SELECT path FROM fx_files)"""
PARTS["offenders"] = """
SELECT 'manifest_paths_exist' AS rule, example FROM absent
UNION ALL SELECT 'label_format_and_ranges', example FROM absent
UNION ALL SELECT 'label_format_and_ranges', concat('labels/', label_file, ':', line_no, ': ', error) FROM lint79
UNION ALL SELECT 'dataset_yaml_paths_resolve', path FROM fx_image_list WHERE path NOT IN (SELECT path FROM fx_files)
UNION ALL SELECT 'all_usable_images_open', path FROM fx_files WHERE size_bytes = 0
UNION ALL SELECT 'no_placeholder_paths', CAST(page_id AS VARCHAR) FROM pages WHERE contains(lower(html), 'path\\to') OR contains(lower(html), 'placeholder')"""
PARTS["offender_counts"] = """
SELECT rule, count(*) AS n, string_agg(example, chr(10) ORDER BY example) FILTER (nth <= 20) AS examples
FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY example) AS nth FROM offenders) GROUP BY rule"""
PARTS["rules"] = """
SELECT name, CASE WHEN coalesce(n, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, concat('count=', coalesce(n, 0), ';examples=', coalesce(examples, '')) AS details
FROM (SELECT unnest(['no_image_source_key_leakage', 'no_project_image_path_leakage', 'no_label_path_leakage', 'manifest_paths_exist', 'label_format_and_ranges',
  'dataset_yaml_paths_resolve', 'all_usable_images_open', 'no_placeholder_paths', 'all_labels_belong_to_single_split']) AS name) x LEFT JOIN offender_counts o ON o.rule = x.name
UNION ALL SELECT 'coco_to_yolo_reversible', 'PASS', 'failures=0'
UNION ALL SELECT 'split_ratios_close_to_80_10_10', CASE WHEN abs(train / total - 0.8) < 0.001 AND abs(val / total - 0.1) < 0.001 THEN 'PASS' ELSE 'FAIL' END,
  concat('test=', test, ';total=', total, ';train=', train, ';val=', val)
FROM (SELECT count(*) AS total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM splits)
UNION ALL SELECT 'source_traceability_present', CASE WHEN n = total THEN 'PASS' ELSE 'FAIL' END, concat('expected=', n, ';total=', total)
FROM (SELECT count(*) AS total FROM splits), (SELECT count(*) AS n FROM fx_images WHERE width > 0 AND height > 0)"""

PARTS["subset_names"] = """
SELECT CASE WHEN ok THEN source END AS source_split, CASE WHEN ok THEN id END AS image_id FROM (
  SELECT regexp_matches(stem, '^(train2017|val2017)_[0-9]{12}$') AS ok, regexp_extract(stem, '^(train2017|val2017)_', 1) AS source, TRY_CAST(right(stem, 12) AS BIGINT) AS id FROM (
    SELECT regexp_extract(CASE WHEN ord % 31 = 0 THEN path || 'x.jpg' ELSE path END, 'images/(.*)\\.[^.]*$', 1) AS stem FROM fx_image_list))"""

PARTS["subset_rows"] = """
SELECT *, CASE WHEN iscrowd <> 0 THEN 'crowd' WHEN class_id IS NULL OR w IS NULL THEN 'other' WHEN inside = 0 THEN 'invalid_box' ELSE 'selected' END AS outcome
FROM reasoned WHERE (source_split, image_id) IN (SELECT (source_split, image_id) FROM subset_names WHERE image_id IS NOT NULL)"""

SQL: dict[str, str] = {}

# ---- scans and sinks ----
def _entries(images: str, annotations: str) -> str:
    """Rows of annotation documents; the arguments select ``split`` and the fields of the entries."""
    return f"""
SELECT split, 'image' AS kind, image_id AS id, image_id, NULL::BIGINT AS category_id, concat_ws('|', file_name, width, height) AS detail,
  NULL::DOUBLE AS x, NULL::DOUBLE AS y, NULL::DOUBLE AS w, NULL::DOUBLE AS h, NULL::DOUBLE AS area, NULL::INT AS iscrowd FROM ({images})
UNION ALL SELECT split, 'annotation', annotation_id, image_id, category_id, NULL, CASE WHEN w IS NOT NULL THEN x END, CASE WHEN w IS NOT NULL THEN y END, w,
  CASE WHEN w IS NOT NULL THEN h END, w * h, iscrowd FROM ({annotations})
UNION ALL SELECT DISTINCT NULL, 'category', category_id, NULL, category_id, concat_ws('|', name, supercategory), NULL, NULL, NULL, NULL, NULL, NULL FROM fx_categories"""


SQL["scan_annotation_json"] = _entries("SELECT *, source_split AS split FROM fx_images", "SELECT *, source_split AS split FROM fx_annotations")
SQL["scan_split_manifest"] = """
SELECT internal_record_id, source_split, image_id, source_image_path, project_image_path, project_label_path, width, height,
  CAST(valid_object_count AS INT) AS valid_object_count, category_names FROM manifest"""
SQL["scan_manifest_jsonl"] = """
SELECT s.source_split, s.image_id, s.split AS project_split, concat('images/', s.split, '/', s.source_split, '_', s.file_name) AS project_image_path,
  concat('labels/', s.split, '/', s.source_split, '_', replace(s.file_name, '.jpg', '.txt')) AS project_label_path, a.annotation_id, a.class_id, a.x, a.w,
  CAST((row_number() OVER (PARTITION BY s.source_split, s.image_id ORDER BY a.annotation_id) - 1) // 1000 AS BIGINT) AS part,
  CAST(ceil(count(*) OVER (PARTITION BY s.source_split, s.image_id) / 1000) AS BIGINT) AS parts
FROM splits s LEFT JOIN accepted a USING (source_split, image_id)"""
SQL["scan_processed_manifests"] = """
SELECT image_id, source_split, file_name, width, height, (SELECT count(*) FROM mapping) AS category_count FROM fx_images"""
SQL["scan_image_list"] = "SELECT row_number() OVER (ORDER BY ord, path) AS place, path FROM fx_image_list"
PARTS["document_files"] = r"""
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '\xFF\xD8\xFF'::BLOB WHEN 1 THEN '\x89PNG\x0D\x0A\x1A\x0A'::BLOB WHEN 2 THEN 'BM'::BLOB
  WHEN 3 THEN 'RIFF\x00\x00\x00\x00WEBP'::BLOB WHEN 4 THEN '\x89PNG'::BLOB ELSE ''::BLOB END || encode(coalesce(text, '') || chr(10)) AS content, coalesce(text, '') AS text
FROM documents"""
SQL["scan_binary_files"] = "SELECT octet_length(content) AS size_bytes, substr(hex(content), 1, 8) AS head FROM document_files"
SQL["file_digests"] = "SELECT octet_length(content) AS size_bytes, sha256(content) AS sha256 FROM document_files"
SQL["image_header_ok"] = """
SELECT sha256(content) AS sha256, doc_id % 6 < 4 OR doc_id % 6 = 5 AND (starts_with(text, 'BM') OR starts_with(text, 'RIFF') AND substr(text, 9, 4) = 'WEBP') AS image_ok FROM document_files"""
SQL["scan_label_lines"] = """
SELECT concat(f.folder, '/', f.file) AS label_file, f.place AS line_no, v.line AS text, v.class_id, v.xc, v.yc, v.w, v.h
FROM (SELECT *, row_number() OVER (PARTITION BY folder, file ORDER BY label_file, line_no) AS place FROM (
    SELECT label_file, line_no, line, substr(label_file, 11, 9) AS folder, CAST(CAST(substr(label_file, 20, 3) AS INT) % 7 AS VARCHAR) AS file FROM fx_label_lines)) f
JOIN label_values v ON v.label_file = f.label_file AND v.line_no = f.line_no"""
SQL["scan_predictions"] = "SELECT image_id, class_id, x, y, w, h, score FROM fx_predictions"
SQL["scan_epoch_metrics"] = "SELECT CAST(epoch AS DOUBLE) AS epoch, train_box_loss, precision_, recall_, map50_95 FROM fx_epochs"
SQL["scan_run_results"] = """
SELECT concat('source_', lpad(CAST(source_id AS VARCHAR), 12, '0')) AS result_id, 'video' AS task_type, processed_frames, total_detections, class_counts, false AS corrupt FROM videos"""
SQL["scan_eval_log"] = """
SELECT p_name AS class_name, p_partkey AS images, CAST(p_size AS BIGINT) AS instances, (p_partkey * 7 % 1000) / 1000 AS precision, (p_partkey * 11 % 1000) / 1000 AS recall,
  (p_partkey * 13 % 1000) / 1000 AS map50, (p_partkey * 17 % 1000) / 1000 AS map50_95 FROM part
UNION ALL SELECT 'speed', NULL, NULL, CAST('0.' || p_size AS DOUBLE), CAST('363.' || p_size AS DOUBLE), 15.1, NULL FROM part WHERE p_partkey % 100 = 0"""
SQL["scan_training_log_flags"] = "SELECT * FROM log_flags"
SQL["training_log_warnings"] = """
SELECT event_id, line FROM train_log WHERE regexp_matches(lower(line), 'warning|deprecated') ORDER BY event_id LIMIT 100"""
SQL["sink_manifest_csv"] = """
SELECT internal_record_id, split, project_image_path, project_label_path, CAST(width AS BIGINT) AS width, valid_object_count FROM manifest"""
SQL["sink_annotation_manifest"] = "SELECT status, count(*) AS annotations FROM classified GROUP BY status"
SQL["sink_label_files"] = """
SELECT concat(i.source_split, '_', lpad(CAST(i.image_id AS VARCHAR), 12, '0'), '.txt') AS label_file, n.pos AS line_no, n.class_id, n.xc, n.yc, n.w, n.h, true AS text_agrees
FROM fx_images i LEFT JOIN numbered n USING (source_split, image_id)"""
SQL["sink_image_list"] = "SELECT concat('images/', split, '/', file_name) AS path, split FROM splits"
SQL["sink_split_jsonl"] = """
SELECT project_split, source_split, count(*) AS images, CAST(sum(greatest(1, ceil(n / 1000))) AS BIGINT) AS records, CAST(sum(n) AS BIGINT) AS annotations
FROM (SELECT s.split AS project_split, s.source_split, s.image_id, count(a.annotation_id) AS n FROM splits s LEFT JOIN accepted a USING (source_split, image_id) GROUP BY ALL) GROUP BY ALL"""
SQL["build_coco_document"] = _entries(
    "SELECT * FROM splits", "SELECT s.split, a.annotation_id, a.image_id, a.category_id, a.x, a.y, a.w, a.h, 0 AS iscrowd FROM accepted a JOIN splits s USING (source_split, image_id)"
)
SQL["sink_predictions"] = "SELECT image_id, category_id, x, y, w, h, score FROM converted"
SQL["sink_metrics"] = """
SELECT m.class_id, m.category_id, m.name AS category_name, count(a.annotation_id) AS object_count FROM mapping m LEFT JOIN accepted a ON a.class_id = m.class_id GROUP BY ALL"""
_LATEST = """
SELECT concat('source_', lpad(CAST(source_id AS VARCHAR), 12, '0')) AS result_id, event_id, class_name, detection_count, inference_ms
FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY frame_ts DESC, event_id DESC) AS rn FROM fx_frames) WHERE rn = 1"""
SQL["sink_result_upsert"] = _LATEST
SQL["latest_result"] = _LATEST

# ---- scalar functions ----
SQL["bbox_clip"] = """
SELECT annotation_id, image_id, CASE WHEN inside = 1 THEN bx END AS clip_x, CASE WHEN inside = 1 THEN by_ END AS clip_y, CASE WHEN inside = 1 THEN bw END AS clip_w,
  CASE WHEN inside = 1 THEN bh END AS clip_h, CASE WHEN inside = 1 THEN round(bx, 3) END AS round_x, CASE WHEN inside = 1 THEN round(by_, 3) END AS round_y,
  CASE WHEN inside = 1 THEN round(bw, 3) END AS round_w, CASE WHEN inside = 1 THEN round(bh, 3) END AS round_h FROM boxed"""
SQL["bbox_to_yolo"] = """
SELECT annotation_id, image_id, reason, CASE WHEN reason IS NULL THEN (bx + bw / 2) / width END AS xc, CASE WHEN reason IS NULL THEN (by_ + bh / 2) / height END AS yc,
  CASE WHEN reason IS NULL THEN bw / width END AS w, CASE WHEN reason IS NULL THEN bh / height END AS h
FROM (SELECT *, CASE WHEN width <= 0 OR height <= 0 THEN 'image_dimensions_not_positive' WHEN w IS NULL THEN 'bbox_needs_four_values'
  WHEN w <= 0 OR h <= 0 THEN 'bbox_size_not_positive' WHEN inside = 0 THEN 'bbox_outside_image' END AS reason FROM boxed)"""
SQL["yolo_to_xyxy"] = """
SELECT label_file, line_no, (xc - w / 2) * 640 AS x1, (yc - h / 2) * 480 AS y1, (xc + w / 2) * 640 AS x2, (yc + h / 2) * 480 AS y2 FROM label_values"""
PARTS["letterboxed"] = """
SELECT *, (640 - CAST(round_even(width * scale, 0) AS BIGINT)) // 2 AS pad_x, (640 - CAST(round_even(height * scale, 0) AS BIGINT)) // 2 AS pad_y
FROM (SELECT *, least(640::DOUBLE / width, 640::DOUBLE / height) AS scale FROM boxed WHERE width > 0 AND height > 0 AND w IS NOT NULL)"""
SQL["letterbox_boxes"] = """
SELECT annotation_id, image_id, scale, pad_x, pad_y, round(x * scale + pad_x, 6) AS x1, round(y * scale + pad_y, 6) AS y1,
  round((x + w) * scale + pad_x, 6) AS x2, round((y + h) * scale + pad_y, 6) AS y2 FROM letterboxed"""
SQL["letterbox_pads_asym"] = """
SELECT image_id, resized_width, resized_height, (416 - resized_width) // 2 AS left, (416 - resized_height) // 2 AS top,
  416 - resized_width - (416 - resized_width) // 2 AS right, 416 - resized_height - (416 - resized_height) // 2 AS bottom
FROM (SELECT image_id, CAST(round_even(width * s, 0) AS BIGINT) AS resized_width, CAST(round_even(height * s, 0) AS BIGINT) AS resized_height
  FROM (SELECT *, least(416::DOUBLE / width, 416::DOUBLE / height) AS s FROM fx_images WHERE width > 0 AND height > 0))"""
SQL["bbox_area"] = """
SELECT annotation_id, image_id, CASE WHEN inside = 1 THEN round(round(bw, 3) * round(bh, 3), 3) END AS area FROM boxed"""
SQL["bbox_clipped_delta"] = """
SELECT annotation_id, image_id, CASE WHEN inside = 1 THEN abs(x - round(bx, 3)) > 1e-6 OR abs(y - round(by_, 3)) > 1e-6 OR abs(w - round(bw, 3)) > 1e-6 OR abs(h - round(bh, 3)) > 1e-6 END AS clipped FROM boxed"""
SQL["size_bucket"] = """
SELECT annotation_id, CASE WHEN w * h < 1024 THEN 'small' WHEN w * h < 9216 THEN 'medium' ELSE 'large' END AS size_bucket FROM fx_annotations"""
SQL["bbox_iou"] = """
SELECT annotation_id, image_id, round(CASE WHEN ow > 0 AND oh > 0 THEN ow * oh / (w * h + (w + image_id % 9) * h - ow * oh) ELSE 0 END, 9) AS iou
FROM (SELECT *, least(x + w, x + annotation_id % 7 + w + image_id % 9) - greatest(x, x + annotation_id % 7) AS ow,
  least(y + h, y + annotation_id % 5 + h) - greatest(y, y + annotation_id % 5) AS oh FROM fx_annotations WHERE w > 0)"""
SQL["parse_project_image"] = """
SELECT CASE WHEN image_id % 10 = 0 THEN concat('other_', file_name) ELSE concat('images/', source_split, '_', replace(file_name, 'jpg', 'JPG')) END AS name,
  CASE WHEN image_id % 10 <> 0 THEN source_split END AS source_split, CASE WHEN image_id % 10 <> 0 THEN image_id END AS image_id,
  CASE WHEN image_id % 10 <> 0 THEN file_name END AS source_file_name FROM fx_images"""
SQL["prediction_image_id"] = """
SELECT det_id, image_id, CASE WHEN regexp_matches(image_id, '^[0-9]+$') THEN TRY_CAST(image_id AS BIGINT)
  ELSE TRY_CAST(nullif(regexp_extract(image_id, '^(train2017|val2017)_([0-9]{12})$', 2), '') AS BIGINT) END AS numeric_id FROM fx_predictions"""
SQL["label_path_for_image"] = """
SELECT CASE image_id % 3 WHEN 0 THEN concat('data/images/train/', file_name) WHEN 1 THEN concat('a/images/images/', file_name) ELSE concat('set/photos/day1/', file_name) END AS image_path,
  CASE image_id % 3 WHEN 0 THEN concat('data/labels/train/', stem) WHEN 1 THEN concat('a/labels/images/', stem) ELSE concat('set/photos/labels/day1/', stem) END AS label_path
FROM (SELECT *, replace(file_name, '.jpg', '.txt') AS stem FROM fx_images)"""
SQL["portable_basename"] = """
SELECT image_id, file_name AS source_name, concat(source_split, '_', file_name) AS project_name FROM fx_images"""
SQL["internal_ids"] = """
SELECT concat(source_split, '_', image_id) AS internal_image_id, concat(source_split, '_', image_id, '_', annotation_id) AS internal_record_id,
  concat(source_split, ':', lpad(CAST(image_id AS VARCHAR), 12, '0')) AS identity_key FROM fx_annotations"""
SQL["safe_output_name"] = """
SELECT page_id, concat(md5(url), '_', left(regexp_replace(CASE WHEN page_id % 4 = 0 THEN concat(base, ' photo') ELSE concat(base, ' photo.', page_id % 7) END, '[^\\p{L}\\p{N}_-]', '_', 'g'), 80),
  '_annotated.', CASE WHEN page_id % 4 = 0 THEN CAST(page_id % 7 AS VARCHAR) ELSE 'jpg' END) AS output_name
FROM (SELECT page_id, url, replace(url, '/', ' ') AS base FROM pages)"""
SQL["file_extension_allowed"] = """
SELECT page_id, concat('upload_', page_id, ['.JPG', '.png', '.gif', '', '.tar.webp', '.mp4'][page_id % 6 + 1]) AS name, page_id % 6 IN (0, 1, 4) AS image_ok, page_id % 6 = 5 AS video_ok FROM pages"""
SQL["valid_result_id"] = """
SELECT page_id, r AS result_id, regexp_full_match(r, '[a-zA-Z0-9_-]{12,64}') AS valid FROM (
  SELECT page_id, CASE WHEN page_id % 3 = 0 THEN md5(url) ELSE regexp_replace(url, '^http://', '') END AS r FROM pages)"""
SQL["codec_tag"] = "SELECT event_id, codec FROM fourcc"
SQL["codec_browser_compatible"] = "SELECT event_id, codec IN ('avc1') AS compatible FROM fourcc"
SQL["effective_fps"] = "SELECT event_id, CASE WHEN event_id % 6 = 0 OR value <= 0 THEN 30::DOUBLE ELSE value END AS fps FROM events"
SQL["video_duration"] = """
SELECT event_id, CASE WHEN event_id % 500 > 0 THEN (event_id % 500) / (CASE WHEN event_id % 6 = 0 OR value <= 0 THEN 30::DOUBLE ELSE value END) ELSE 0 END AS duration_seconds FROM events"""
SQL["latency_to_fps"] = "SELECT event_id, CASE WHEN event_id % 9 = 0 OR value <= 0 THEN 0 ELSE 1000::DOUBLE / value END AS fps FROM events"
SQL["path_excluded"] = "SELECT page_id, path, prohibited AS excluded FROM archive_flags JOIN archive_paths USING (page_id)"
SQL["archive_entry_flags"] = "SELECT * EXCLUDE (size_bytes) FROM archive_flags"
SQL["file_size_ok"] = "SELECT path, size_bytes <= 524288 AS ok, round(size_bytes / 1048576::DOUBLE, 3) AS size_mb FROM fx_files"
SQL["threshold_valid"] = "SELECT event_id, value / 250 BETWEEN 0 AND 1 AS valid FROM events"

# ---- filters ----
SQL["classify_annotations"] = """
SELECT concat(source_split, '_', image_id, '_', annotation_id) AS internal_record_id, source_split, image_id, annotation_id, category_id, category_name, class_id, status, reason,
  CASE WHEN status = 'accepted' THEN bx END AS clip_x, CASE WHEN status = 'accepted' THEN by_ END AS clip_y, CASE WHEN status = 'accepted' THEN bw END AS clip_w, CASE WHEN status = 'accepted' THEN bh END AS clip_h,
  CASE WHEN status = 'accepted' THEN (bx + bw / 2) / width END AS yolo_xc, CASE WHEN status = 'accepted' THEN (by_ + bh / 2) / height END AS yolo_yc,
  CASE WHEN status = 'accepted' THEN bw / width END AS yolo_w, CASE WHEN status = 'accepted' THEN bh / height END AS yolo_h FROM classified"""
PARTS["conversion"] = """
SELECT *, CASE WHEN iscrowd <> 0 THEN 'crowd_annotations_skipped' WHEN w IS NULL OR class_id IS NULL THEN 'unsupported_annotations'
  WHEN width <= 0 OR height <= 0 OR w <= 0 OR h <= 0 OR inside = 0 THEN 'invalid_boxes' ELSE 'annotations_written' END AS outcome FROM reasoned"""
SQL["convert_annotations"] = """
SELECT annotation_id, image_id, class_id, outcome, CASE WHEN outcome = 'annotations_written' THEN (bx + bw / 2) / width END AS xc, CASE WHEN outcome = 'annotations_written' THEN (by_ + bh / 2) / height END AS yc,
  CASE WHEN outcome = 'annotations_written' THEN bw / width END AS w, CASE WHEN outcome = 'annotations_written' THEN bh / height END AS h FROM conversion"""
SQL["convert_annotations_counters"] = "SELECT outcome, count(*) AS annotations FROM conversion GROUP BY outcome"
PARTS["checked_images"] = """
SELECT i.*, CASE WHEN f.path IS NULL THEN 'missing' WHEN f.size_bytes % 10 = 0 THEN 'corrupt' ELSE 'written' END AS state
FROM fx_images i LEFT JOIN fx_files f ON f.path = concat('images/', i.source_split, '_', i.file_name)"""
SQL["convert_annotations_report"] = """
SELECT i.*, a.* EXCLUDE (source_split), annotations_seen FROM (
  SELECT source_split, count(*) AS images_seen, count(*) FILTER (state = 'written') AS images_written, count(*) FILTER (state = 'missing') AS missing_images,
    count(*) FILTER (state = 'corrupt') AS corrupt_images FROM checked_images GROUP BY source_split) i
JOIN (SELECT source_split, count(*) AS annotations_seen FROM fx_annotations GROUP BY source_split) n USING (source_split)
JOIN (SELECT c.source_split, count(*) FILTER (outcome = 'annotations_written') AS annotations_written, count(*) FILTER (outcome = 'invalid_boxes') AS invalid_boxes,
    count(*) FILTER (outcome = 'unsupported_annotations') AS unsupported_annotations, count(*) FILTER (outcome = 'crowd_annotations_skipped') AS crowd_annotations_skipped
  FROM conversion c JOIN checked_images i ON i.image_id = c.image_id AND i.source_split = c.source_split AND i.state = 'written' GROUP BY 1) a USING (source_split)"""
SQL["usable_images"] = """
SELECT i.* FROM fx_images i WHERE width > 0 AND height > 0 AND concat('images/', source_split, '_', file_name) IN (SELECT path FROM fx_files)"""
SQL["resolve_class_filter"] = """
SELECT entry_id, entry, CASE WHEN regexp_matches(trim(entry), '^[0-9]+$') THEN TRY_CAST(trim(entry) AS BIGINT) ELSE m.class_id END AS class_id
FROM (SELECT p_partkey AS entry_id, CASE p_partkey % 3 WHEN 0 THEN upper(concat(p_name, ' ', p_partkey)) WHEN 1 THEN concat(' ', p_partkey) ELSE p_name END AS entry FROM part) e
LEFT JOIN mapping m ON lower(m.name) = lower(trim(entry))"""
SQL["filter_by_class"] = """
SELECT det_id, image_id, class_id, score FROM converted WHERE class_id IN (SELECT class_id FROM mapping WHERE supercategory = (SELECT max(supercategory) FROM mapping))"""
SQL["filter_confidence"] = "SELECT det_id, image_id, score FROM fx_predictions WHERE score >= 0.25::DOUBLE"
SQL["lint_label_lines"] = "SELECT * FROM lint79"
SQL["lint_label_lines_smoke"] = _lint("OR class_id > 79")
SQL["lint_label_lines_project"] = _lint("")
SQL["lint_coco_subset"] = """
SELECT 'non_positive_dimensions' AS rule, concat(source_split, ':', image_id) AS key FROM fx_images WHERE width <= 0 OR height <= 0
UNION ALL SELECT 'duplicate_image_id', concat(source_split, ':', image_id) FROM fx_images GROUP BY source_split, image_id HAVING count(*) > 1
UNION ALL SELECT 'duplicate_annotation_id', CAST(annotation_id AS VARCHAR) FROM fx_annotations GROUP BY annotation_id HAVING count(*) > 1
UNION ALL SELECT 'image_count', CAST(count(*) AS VARCHAR) FROM fx_images HAVING count(*) <> 2500
UNION ALL SELECT 'category_count', CAST(count(*) AS VARCHAR) FROM fx_categories HAVING count(*) <> 80
UNION ALL SELECT rule, key FROM (SELECT CAST(annotation_id AS VARCHAR) AS key, unnest([CASE WHEN category_id NOT IN (SELECT category_id FROM fx_categories) THEN 'missing_category' END,
    CASE WHEN w IS NULL THEN 'invalid_bbox_shape' END, CASE WHEN w IS NOT NULL AND (x < 0 OR y < 0) THEN 'negative_coordinate' END,
    CASE WHEN w <= 0 OR (w IS NOT NULL AND h <= 0) THEN 'non_positive_size' END,
    CASE WHEN w IS NOT NULL AND width > 0 AND height > 0 AND (x + w > width + 1e-6 OR y + h > height + 1e-6) THEN 'exceeds_image' END]) AS rule FROM boxed) WHERE rule IS NOT NULL"""

# ---- joins ----
SQL["join_annotations_images"] = "SELECT annotation_id, image_id, source_split, width, height FROM boxed"
SQL["join_category_lookup"] = """
SELECT a.annotation_id, a.image_id, a.category_id, m.name AS category_name, m.class_id FROM fx_annotations a LEFT JOIN mapping m USING (category_id)"""
SQL["reconstruct_split"] = "SELECT * FROM rebuilt"
SQL["reconstruct_totals"] = "SELECT * FROM rebuilt_totals"
SQL["subset_manifest"] = """
SELECT c.internal_record_id, c.split, c.pick, c.valid_object_count, coalesce(l.label_lines, 0) AS label_lines, coalesce(l.classes, 0) AS classes
FROM chosen c LEFT JOIN line_counts l USING (label_file)"""
PARTS["split_lines"] = """
SELECT s.split, v.class_id, coalesce(m.name, CAST(v.class_id AS VARCHAR)) AS name
FROM splits s JOIN label_values v ON v.label_file = concat('train2017_', lpad(CAST(s.image_id AS VARCHAR), 12, '0'), '.txt') LEFT JOIN mapping m ON m.class_id = v.class_id"""
SQL["subset_totals"] = """
SELECT i.split, i.images, coalesce(l.annotations, 0) AS annotations, CAST(coalesce(c.classes, 0) AS INT) AS represented_class_count, c.listed AS represented_classes
FROM (SELECT split, count(*) AS images FROM splits GROUP BY GROUPING SETS ((split), ())) i
LEFT JOIN (SELECT split, count(*) AS annotations FROM split_lines GROUP BY GROUPING SETS ((split), ())) l ON l.split IS NOT DISTINCT FROM i.split
LEFT JOIN (SELECT split, count(*) AS classes, string_agg(class_id || ':' || name, ',' ORDER BY class_id, name) AS listed FROM (
  SELECT split, class_id, name FROM split_lines WHERE class_id IS NOT NULL GROUP BY GROUPING SETS ((split, class_id, name), (class_id, name))) GROUP BY split) c ON c.split IS NOT DISTINCT FROM i.split"""
SQL["subset_semi_join"] = """
SELECT a.annotation_id, a.source_split, a.image_id, a.category_id, a.image_id AS ord FROM fx_annotations a JOIN splits s USING (source_split, image_id) WHERE s.split = 'test'"""
SQL["missing_images"] = "SELECT image_path AS path FROM paths WHERE image_path NOT IN (SELECT path FROM fx_files)"
SQL["missing_labels"] = "SELECT label_path AS path FROM paths WHERE label_path NOT IN (SELECT path FROM fx_files)"
SQL["manifest_availability"] = "SELECT * FROM availability"
SQL["split_leakage"] = """
SELECT kind, left_split, right_split, CASE WHEN kind = 'image_path' THEN 0 ELSE n END AS overlaps FROM (
  SELECT 'test' AS left_split, 'train' AS right_split, count(*) AS n FROM leaky a JOIN leaky b USING (source_split, image_id) WHERE a.split = 'test' AND b.split = 'train'
  UNION ALL SELECT 'test', 'val', count(*) FROM leaky a JOIN leaky b USING (source_split, image_id) WHERE a.split = 'test' AND b.split = 'val'
  UNION ALL SELECT 'train', 'val', count(*) FROM leaky a JOIN leaky b USING (source_split, image_id) WHERE a.split = 'train' AND b.split = 'val'),
  (VALUES ('source_key'), ('image_path'), ('label_name')) k(kind)"""
SQL["label_roundtrip"] = """
SELECT count(*) AS positions, count(*) FILTER (image_id % 83 = 0 AND pos = 1) AS missing_lines, CAST(0 AS BIGINT) AS extra_lines,
  count(*) FILTER (image_id % 89 = 0 AND NOT (image_id % 83 = 0 AND pos = 1)) AS mismatches FROM numbered"""


def _draw(label: str, low: str, high: str) -> str:
    number = f"CAST(('0x' || left(md5('42:{label}:' || source), 8)) AS BIGINT)"
    return f"CASE WHEN c = 'occlusion' THEN {low} + {number} % ({high} - {low} + 1) END AS occlusion_{label}"


SQL["robustness_grid"] = f"""
SELECT c AS "case", source, concat('results/robustness/', c, '/', file_name) AS output, {_draw("x1", "0", "width // 2")}, {_draw("y1", "0", "height // 2")},
  {_draw("x2", "width // 2", "width")}, {_draw("y2", "height // 2", "height")}
FROM (SELECT concat('raw/', source_split, '/', file_name) AS source, file_name, CAST(width AS BIGINT) AS width, CAST(height AS BIGINT) AS height,
  unnest(['low_lighting', 'bright_lighting', 'occlusion', 'small_objects', 'scale_variation', 'motion_blur', 'complex_backgrounds', 'multiple_objects']) AS c FROM usable)"""

# ---- aggregations ----
SQL["source_split_stats"] = """
SELECT i.source_split, i.images, a.annotations, a.duplicate_annotation_ids, c.accepted_annotations, c.crowd_annotations, c.rejected_annotations, a.annotations - c.n AS orphan_annotations
FROM (SELECT source_split, count(*) AS images FROM fx_images GROUP BY 1) i
JOIN (SELECT source_split, count(*) AS annotations, count(*) - count(DISTINCT annotation_id) AS duplicate_annotation_ids FROM fx_stated_annotations GROUP BY 1) a USING (source_split)
JOIN (SELECT source_split, count(*) AS n, count(*) FILTER (status = 'accepted') AS accepted_annotations, count(*) FILTER (status = 'excluded') AS crowd_annotations,
  count(*) FILTER (status = 'rejected') AS rejected_annotations FROM classified GROUP BY 1) c USING (source_split)"""
SQL["reason_counts"] = "SELECT status, reason, count(*) AS annotations FROM classified WHERE status <> 'accepted' GROUP BY ALL"
SQL["class_object_counts"] = SQL["sink_metrics"]
SQL["class_image_counts"] = """
SELECT m.class_id, m.category_id, m.name AS category_name, count(DISTINCT a.source_split || '_' || a.image_id) AS image_count FROM mapping m LEFT JOIN accepted a ON a.class_id = m.class_id GROUP BY ALL"""
SQL["class_split_pivot"] = """
SELECT m.class_id, m.category_id, m.name AS category_name, count(a.annotation_id) AS object_count, count(DISTINCT a.source_split || '_' || a.image_id) AS image_count,
  count(*) FILTER (s.split = 'train') AS train, count(*) FILTER (s.split = 'val') AS val, count(*) FILTER (s.split = 'test') AS test
FROM mapping m LEFT JOIN accepted a ON a.class_id = m.class_id LEFT JOIN splits s ON s.source_split = a.source_split AND s.image_id = a.image_id GROUP BY ALL"""
SQL["image_rollup"] = "SELECT * EXCLUDE (name_list) FROM rollup"


def _distribution(label: str, source: str, column: str) -> str:
    return (
        f"SELECT '{label}' AS distribution, count({column}) AS count, round(CAST(min({column}) AS DOUBLE), 9) AS min, round(CAST(max({column}) AS DOUBLE), 9) AS max, "
        f"round(avg({column}), 9) AS mean, round(CAST(median({column}) AS DOUBLE), 9) AS median FROM {source}"
    )


SQL["distribution_summary"] = " UNION ALL ".join(
    [
        _distribution("objects_per_image", "rollup", "valid_object_count"),
        _distribution("bbox_width", "accepted", "yw"),
        _distribution("bbox_height", "accepted", "yh"),
        _distribution("bbox_area", "(SELECT bw * bh AS area FROM accepted)", "area"),
    ]
)
SQL["distribution_sketches"] = f"""SELECT distribution, count, min, max, mean, true AS ranks_close FROM ({SQL["distribution_summary"]})"""
SQL["size_bucket_counts"] = """
SELECT CASE WHEN bw * bh < 1024 THEN 'small' WHEN bw * bh < 9216 THEN 'medium' ELSE 'large' END AS size_bucket, count(*) AS objects FROM accepted GROUP BY 1"""


def _histogram(chart: str, source: str, bins: int) -> str:
    return (
        f"SELECT least(CAST(floor((v - lo) / ((hi - lo) / {bins})) AS BIGINT), {bins - 1}) AS bin, count(*) AS rows, '{chart}' AS chart "
        f"FROM (SELECT CAST(v AS DOUBLE) AS v, CAST(min(v) OVER () AS DOUBLE) AS lo, CAST(max(v) OVER () AS DOUBLE) AS hi FROM ({source})) GROUP BY 1"
    )


SQL["histogram"] = " UNION ALL ".join(
    [
        _histogram("objects_per_image", "SELECT valid_object_count AS v FROM rollup", 50),
        _histogram("bbox_area", "SELECT bw * bh AS v FROM accepted", 80),
    ]
)
SQL["split_summary"] = """
SELECT s.split, count(*) AS images, CAST(sum(coalesce(a.n, 0)) AS BIGINT) AS annotations, round(count(*) / any_value(t.n) * 100, 4) AS percentage
FROM splits s LEFT JOIN (SELECT source_split, image_id, count(*) AS n FROM accepted GROUP BY ALL) a USING (source_split, image_id), (SELECT count(*) AS n FROM splits) t GROUP BY s.split"""
SQL["dataset_profile"] = """
SELECT c.*, r.* FROM (SELECT count(*) AS total_annotations, count(*) FILTER (status = 'accepted') AS accepted_annotations, count(*) FILTER (status = 'rejected') AS rejected_annotations,
  count(*) FILTER (status = 'excluded') AS excluded_crowd_annotations, count(*) FILTER (starts_with(reason, 'invalid_bbox')) AS invalid_boxes,
  count(*) FILTER (status = 'accepted' AND bw * bh < 1024) AS small_objects, count(*) FILTER (status = 'accepted' AND bw * bh >= 1024 AND bw * bh < 9216) AS medium_objects,
  count(*) FILTER (status = 'accepted' AND bw * bh >= 9216) AS large_objects, round(avg(CASE WHEN status = 'accepted' THEN bw / width END), 9) AS mean_width,
  round(avg(CASE WHEN status = 'accepted' THEN bh / height END), 9) AS mean_height, round(avg(CASE WHEN status = 'accepted' THEN bw * bh END), 9) AS mean_area FROM classified) c,
 (SELECT count(*) AS total_source_images, count(*) FILTER (usable_for_training) AS total_usable_images, count(*) FILTER (valid_object_count = 0) AS images_with_zero_accepted_objects,
  max(valid_object_count) AS max_objects_per_image, round(avg(valid_object_count), 9) AS mean_objects_per_image FROM rollup) r"""
SQL["represented_classes"] = "SELECT class_id, category_name, count(*) AS annotations FROM accepted GROUP BY ALL"
SQL["label_counts"] = """
SELECT f.label_file, coalesce(l.label_lines, 0) AS label_lines, coalesce(l.classes, 0) AS classes
FROM (SELECT concat('train2017_', lpad(CAST(image_id AS VARCHAR), 12, '0'), '.txt') AS label_file FROM fx_images) f LEFT JOIN line_counts l USING (label_file)"""
SQL["duplicate_count"] = """
SELECT 'image_list' AS source, count(*) - count(DISTINCT path) AS duplicates FROM fx_image_list
UNION ALL SELECT 'annotations', count(*) - count(DISTINCT annotation_id) FROM fx_annotations"""
PARTS["named_counts"] = """
SELECT image_id, string_agg(name || ':' || n, ',' ORDER BY name) AS class_counts FROM (
  SELECT c.image_id, m.name, count(*) AS n FROM converted c JOIN mapping m ON m.class_id = c.class_id GROUP BY ALL) GROUP BY image_id"""
SQL["detection_class_counts"] = "SELECT * FROM named_counts"
SQL["confidence_stats"] = """
SELECT i.image_id, count(c.det_id) AS detection_count, min(score) AS min, max(score) AS max, round(avg(score), 9) AS mean FROM fx_images i LEFT JOIN converted c USING (image_id) GROUP BY 1"""
SQL["sample_summary"] = """
SELECT i.image_id, i.file_name, i.width, i.height, CAST(i.image_id * 31 % 4000 AS DOUBLE) / 10 AS inference_time_ms, count(c.det_id) AS detection_count, min(score) AS min, max(score) AS max, round(avg(score), 9) AS mean, coalesce(any_value(n.class_counts), '') AS class_counts
FROM usable i LEFT JOIN converted c USING (image_id) LEFT JOIN named_counts n USING (image_id) GROUP BY 1, 2, 3, 4"""
SQL["video_summary"] = "SELECT * FROM videos"
SQL["latency_benchmark"] = """
SELECT source_id, count(*) AS num_images, round(avg(inference_ms), 9) AS latency_ms_mean, min(inference_ms) AS latency_ms_min, max(inference_ms) AS latency_ms_max,
  round(coalesce(avg(CASE WHEN inference_ms > 0 THEN 1000 / inference_ms END), 0), 9) AS fps_mean, round(avg(CASE WHEN event_id % 3 = 0 THEN inference_ms / 10 END), 9) AS nms_ms_mean,
  round(median(inference_ms), 9) AS latency_ms_median
FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY frame_ts, event_id) AS rn FROM fx_frames) WHERE rn > 5 GROUP BY 1"""
# Runs of 100,000 sorted keys are hashed, and the digests of a split's runs once more.
SQL["identity_hash"] = """
SELECT split, sha256(string_agg(digest, chr(10) ORDER BY run) || chr(10)) AS sha256, CAST(sum(n) AS BIGINT) AS count FROM (
  SELECT split, run, count(*) AS n, sha256(string_agg(key, chr(10) ORDER BY key) || chr(10)) AS digest FROM (
    SELECT split, key, (row_number() OVER (PARTITION BY split ORDER BY key) - 1) // 100000 AS run FROM (
      SELECT split, concat(source_split, ':', lpad(CAST(image_id AS VARCHAR), 12, '0')) AS key FROM splits)) GROUP BY ALL) GROUP BY split"""
SQL["identity_hash_order_free"] = """
SELECT split, count(*) AS count, concat(sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)), ':', sum(CAST('0x' || substr(h, 16, 15) AS BIGINT))) AS digest
FROM (SELECT split, md5(concat(source_split, ':', lpad(CAST(image_id AS VARCHAR), 12, '0'))) AS h FROM splits) GROUP BY split"""
SQL["file_counts"] = """
SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS directory, regexp_extract(path, '\\.([^.]*)$', 1) AS extension, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS size_bytes FROM fx_files GROUP BY ALL"""

# ---- ordered operators ----
SQL["category_mapping"] = """
SELECT p_partkey * 2 + 1 AS category_id, p_name AS name, p_type AS supercategory, row_number() OVER (ORDER BY p_partkey) - 1 AS class_id FROM part"""


def _best(label: str, column: str, direction: str) -> str:
    order = "DESC" if direction == "max" else "ASC"
    return (
        f"SELECT '{label}' AS metric, '{direction}' AS direction, (SELECT {column} FROM fx_epochs ORDER BY epoch DESC LIMIT 1) AS final, (SELECT max(epoch) FROM fx_epochs) AS final_epoch, "
        f"{column} AS best, epoch AS best_epoch, n AS total_completed_epochs, CASE WHEN n <> 300 THEN concat(n, ' epochs completed although 300 were configured.') ELSE concat(n, ' epochs completed.') END AS completed_epochs_note "
        f"FROM (SELECT *, row_number() OVER (ORDER BY {column} {order}, epoch) AS rn, count(*) OVER () AS n FROM fx_epochs) WHERE rn = 1"
    )


SQL["best_epoch"] = " UNION ALL ".join(
    [
        _best("training_box_loss", "train_box_loss", "min"),
        _best("precision", "precision_", "max"),
        _best("recall", "recall_", "max"),
        _best("mAP@0.5:0.95", "map50_95", "max"),
    ]
)
SQL["last_epoch_metrics"] = """
SELECT epoch, train_box_loss AS box_loss, precision_ AS precision, recall_ AS recall, map50_95 AS map FROM fx_epochs ORDER BY epoch DESC LIMIT 1"""
SQL["frame_fps"] = "SELECT source_id, event_id, frame_index, instantaneous_fps FROM rates"
SQL["moving_fps"] = "SELECT source_id, event_id, frame_index, moving_average_fps FROM rates"
SQL["pr_curve"] = """
SELECT class_id, CAST(n AS BIGINT) AS position, score, CAST(tp AS BIGINT) AS tp, round(rc, 9) AS recall, round(tp / n, 9) AS precision, round(env, 9) AS envelope FROM curve WHERE area_no = 0 AND t = 0 AND hit"""
SQL["max_dets_rank"] = "SELECT image_id, class_id, det_id, score, rk AS rank FROM ranked WHERE rk <= 10"

# ---- top-k and sampling ----
SQL["strongest_classes"] = "SELECT class_name, map50_95 FROM class_report ORDER BY map50_95 DESC, class_name LIMIT 5"
SQL["weakest_classes"] = "SELECT class_name, map50_95 FROM class_report ORDER BY map50_95, class_name LIMIT 5"
SQL["preview_n"] = "SELECT image_path AS path FROM paths WHERE image_path NOT IN (SELECT path FROM fx_files) ORDER BY 1 LIMIT 10"
SQL["seeded_split"] = "SELECT internal_record_id, split FROM splits"
SQL["seeded_split_threshold"] = """
SELECT internal_record_id, CASE WHEN share < 0.8::DOUBLE THEN 'train' WHEN share < 0.8::DOUBLE + 0.1::DOUBLE THEN 'val' ELSE 'test' END AS split
FROM (SELECT internal_record_id, CAST(('0x' || left(md5('42:' || internal_record_id), 8)) AS BIGINT) / 4294967296::DOUBLE AS share FROM usable)"""
SQL["seeded_sample"] = "SELECT image_path AS path FROM paths ORDER BY md5('42:' || image_path), image_path LIMIT 1000"
SQL["diverse_sample"] = "SELECT split, CAST(pick AS INT) AS pick, internal_record_id, valid_object_count, category_names FROM chosen"
SQL["candidate_scan_first"] = """
SELECT root_rank, path, resolved FROM (SELECT *, row_number() OVER (PARTITION BY resolved ORDER BY root_rank, path) AS rn FROM (
  SELECT CAST(page_id % 3 AS INT) AS root_rank, concat('root', page_id % 3, '/', page_id, '.jpg') AS path, concat('real/', page_id // 2) AS resolved FROM pages WHERE page_id % 4 <> 0))
WHERE rn = 1 ORDER BY root_rank, path LIMIT 20"""

# ---- set operations ----
SQL["union_sources"] = "SELECT source_split, count(*) AS images, CAST(sum(width) AS BIGINT) AS width_sum FROM fx_images GROUP BY 1"
SQL["overlap_keys"] = """
SELECT source_split, image_id FROM leaky WHERE split = 'train' INTERSECT SELECT source_split, image_id FROM leaky WHERE split = 'test'"""
SQL["required_files_missing"] = "SELECT path FROM fx_image_list EXCEPT ALL SELECT DISTINCT path FROM fx_files"
SQL["dedupe_records"] = "SELECT source_split, image_id, count(*) AS copies FROM leaky GROUP BY ALL HAVING count(*) > 1"

# ---- quality ----
SQL["validation_rules"] = "SELECT * FROM rules"
SQL["validation_readiness"] = "SELECT count(*) AS rules, count(*) FILTER (status = 'FAIL') AS failed, bool_and(status = 'PASS') AS final_readiness FROM rules"
SQL["smoke_rules"] = """
SELECT name, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, CAST(d AS VARCHAR) AS details FROM (
  SELECT 'train_image_count' AS name, count(*) = 32 AS ok, count(*) AS d FROM chosen WHERE split = 'train'
  UNION ALL SELECT 'val_image_count', count(*) = 16, count(*) FROM chosen WHERE split = 'val'
  UNION ALL SELECT 'every_image_has_label', count(*) = 0, count(*) FROM chosen WHERE concat('labels/', source_split, '_', lpad(CAST(image_id AS VARCHAR), 12, '0'), '.txt') NOT IN (SELECT path FROM fx_files)
  UNION ALL SELECT 'label_format_and_ranges', count(*) = 0, count(*) FROM lint79 WHERE label_file IN (SELECT label_file FROM chosen)
  UNION ALL SELECT 'no_smoke_split_leakage', true, 0
  UNION ALL SELECT 'dataset_yaml_resolves', count(*) = 80, count(*) FROM mapping)"""
SQL["extraction_rules"] = """
SELECT source_split, CAST(sum(n) AS BIGINT) AS images, CAST(sum(n - 1) AS BIGINT) AS duplicate_file_names, any_value(a.annotations) AS annotations,
  CAST(sum(missing) AS BIGINT) AS missing_images, CAST(sum(corrupt) AS BIGINT) AS corrupt_images, sum(missing) + sum(corrupt) = 0 AS valid
FROM (SELECT source_split, file_name, count(*) AS n, count(*) FILTER (concat('images/', source_split, '_', file_name) NOT IN (SELECT path FROM fx_files)) AS missing,
    count(*) FILTER (concat('images/', source_split, '_', file_name) IN (SELECT path FROM fx_files WHERE size_bytes % 1000 = 0)) AS corrupt FROM fx_images GROUP BY ALL) i
JOIN (SELECT source_split, count(*) AS annotations FROM fx_annotations GROUP BY 1) a USING (source_split) GROUP BY source_split"""
SQL["split_ratio_check"] = """
SELECT count(*) AS total, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test,
  abs(count(*) FILTER (split = 'train') / count(*) - 0.8) < 0.001 AND abs(count(*) FILTER (split = 'val') / count(*) - 0.1) < 0.001 AS passed FROM splits"""
SQL["compare_expected"] = """
SELECT item, CAST(e.value AS VARCHAR) AS expected, CAST(a.value AS VARCHAR) AS actual, CASE WHEN e.value IS NOT DISTINCT FROM a.value THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT CASE WHEN status = 'excluded' THEN 'excluded_crowd_annotations' WHEN reason = 'invalid_category_id' THEN 'rejected_annotations' WHEN status = 'accepted' THEN 'accepted_annotations'
    ELSE 'rejected_invalid_boxes' END AS item, count(*) AS value FROM classified JOIN splits USING (source_split, image_id) GROUP BY 1) e
FULL JOIN (SELECT counter AS item, value FROM rebuilt_totals) a USING (item)"""
PARTS["listed_lines"] = "SELECT concat('labels/', label_file) AS label_file, count(*) AS n FROM fx_label_lines WHERE trim(line) <> '' GROUP BY 1"
PARTS["sampled"] = "SELECT image_path AS path FROM paths ORDER BY md5('42:' || image_path), image_path LIMIT 1000"


def _inspect(source: str, prefix: str) -> str:
    return f"""(SELECT count(*) AS {prefix}line_count, count(*) - count(DISTINCT p.path) AS {prefix}duplicate_count, count(*) FILTER (i.path IS NULL) AS {prefix}missing_image_count,
  count(*) FILTER (l.path IS NULL) AS {prefix}missing_label_count, CAST(coalesce(sum(n.n) FILTER (l.path IS NOT NULL), 0) AS BIGINT) AS {prefix}labeled_instance_count
FROM (SELECT path, replace(replace(path, 'images/', 'labels/'), '.jpg', '.txt') AS label FROM {source}) p LEFT JOIN fx_files i ON i.path = p.path LEFT JOIN fx_files l ON l.path = p.label
LEFT JOIN listed_lines n ON n.label_file = p.label)"""


SQL["subset_verification"] = f"""
SELECT *, CASE WHEN source_duplicate_count + source_missing_image_count + source_missing_label_count + subset_duplicate_count + subset_missing_image_count + subset_missing_label_count = 0
  AND subset_line_count = 1000 THEN 'passed' ELSE 'failed' END AS verification_status FROM {_inspect("fx_image_list", "source_")}, {_inspect("sampled", "subset_")}"""
SQL["subset_annotation_report"] = """
SELECT s.*, f.*, k.category_count FROM (
  SELECT count(*) FILTER (outcome = 'selected') AS selected_annotation_count, count(*) FILTER (outcome = 'crowd') AS excluded_crowd_annotation_count,
    count(*) FILTER (outcome = 'invalid_box') AS rejected_invalid_box_count, count(*) FILTER (outcome = 'other') AS rejected_other_annotation_count,
    count(*) FILTER (outcome = 'selected' AND (abs(x - round(bx, 3)) > 1e-6 OR abs(y - round(by_, 3)) > 1e-6 OR abs(w - round(bw, 3)) > 1e-6 OR abs(h - round(bh, 3)) > 1e-6)) AS clipped_box_count,
    count(*) FILTER (outcome = 'selected') - count(DISTINCT annotation_id) FILTER (outcome = 'selected') AS duplicate_annotation_id_count FROM subset_rows) s,
 (SELECT count(image_id) AS selected_image_count, count(image_id) - count(DISTINCT image_id) AS duplicate_image_id_count, count(*) - count(image_id) AS missing_image_mapping_count FROM subset_names) f,
 (SELECT count(*) AS category_count FROM mapping) k"""
SQL["evaluation_readiness"] = """
SELECT true AS checkpoint_exists, true AS yaml_exists, true AS manifest_exists, 'images/train' AS yaml_train, 'images/val' AS yaml_val, 'images/test' AS yaml_test, 'test_manifest.csv' AS manifest_name,
  usable_image_label_pairs AS usable_pairs, rows = 2500 AS exact_subset_available, true AS no_validation_data_substitution, true AS no_training_data_substitution, false AS refused_validation_manifest,
  CASE WHEN usable_image_label_pairs = 0 THEN 'Test manifest has no usable image/label pairs.' ELSE '' END AS blocking_issues,
  CASE WHEN usable_image_label_pairs = 0 THEN 'blocked' WHEN rows = 2500 THEN 'ready_for_exact_2500_test_evaluation' ELSE 'ready_for_full_project_test_evaluation_exact_2500_subset_missing' END AS evaluation_readiness_status
FROM availability"""
SQL["manifest_candidates"] = "SELECT * FROM listing"
SQL["find_manifest_by_rows"] = """
SELECT min(path) FILTER (row_count = 12 AND contains(path, 'test')) AS path, coalesce(bool_or(row_count = 12 AND contains(path, 'test')), false) AS available, count(*) AS candidate_files FROM listing"""
SQL["artifact_inventory"] = """
SELECT p.path, f.path IS NOT NULL AS generated, CASE WHEN f.path IS NULL THEN 'not generated' END AS reason FROM (SELECT DISTINCT path FROM fx_image_list) p LEFT JOIN fx_files f USING (path)"""
PARTS["evidence"] = """
SELECT l.* EXCLUDE (line_count), c.*, true AS learning_rate_scheduling_executed, r.ok AS dataset_ready, l.box_loss_executed AS forward_pass_completed
FROM log_flags l, (SELECT bool_or(c_custkey % 2 = 0 AND c_acctbal > 0) AS best_checkpoint_written, bool_or(c_custkey % 2 <> 0 AND c_acctbal > 0) AS last_checkpoint_written,
  bool_or(c_acctbal > 5000) AS backward_and_optimizer_update_completed, true AS checkpoints_valid FROM customer) c, (SELECT bool_and(status = 'PASS') AS ok FROM rules) r"""
SQL["run_readiness"] = """
SELECT *, pretrained_weights_loaded AND model_architecture_initialized AND training_images_discovered AND validation_images_discovered AND box_loss_executed AND objectness_loss_executed
  AND classification_loss_executed AND optimizer_configured AND validation_completed AND checkpoint_logged AND best_checkpoint_written AND last_checkpoint_written
  AND backward_and_optimizer_update_completed AND checkpoints_valid AND learning_rate_scheduling_executed AND dataset_ready AS full_training_readiness FROM evidence"""
SQL["model_card"] = """
SELECT (SELECT count(*) FROM mapping) AS number_of_classes, (SELECT count(*) FROM customer) AS checkpoint_parameter_count, CAST(NULL AS BIGINT) AS checkpoint_class_count,
  (SELECT count(*) FROM fx_epochs) AS trained_completed_epochs, CAST(80 AS BIGINT) AS trained_class_count, (SELECT count(*) FROM fx_image_list) AS subset_line_count, CAST(80 AS BIGINT) AS class_count"""
SQL["archive_audit"] = """
SELECT count(*) AS file_count, CAST(sum(size_bytes) AS BIGINT) AS size_bytes, count(*) FILTER (absolute_path) AS absolute_path_errors, count(*) FILTER (path_traversal) AS path_traversal_errors,
  count(*) FILTER (prohibited) AS prohibited_errors, count(*) FILTER (model_file) AS model_file_errors, count(*) FILTER (dataset_media) AS dataset_media_errors,
  count(*) FILTER (absolute_path OR path_traversal OR prohibited OR model_file OR dataset_media) = 0 AS valid FROM archive_flags"""

# ---- detection evaluation ----
SQL["convert_predictions"] = "SELECT * FROM conversions"
SQL["conversion_counters"] = """
SELECT count(*) AS source_prediction_count, count(*) FILTER (outcome = 'converted') AS converted_prediction_count, count(*) FILTER (outcome = 'dropped_unknown_image') AS dropped_unknown_image_count,
  count(*) FILTER (outcome = 'dropped_unknown_category') AS dropped_unknown_category_count, count(*) FILTER (outcome = 'dropped_invalid_bbox') AS dropped_invalid_bbox_count FROM conversions"""
SQL["match_detections"] = """
SELECT image_id, class_id, det_id, gt_id, threshold AS iou_threshold FROM matches JOIN thresholds USING (t) WHERE area_no = 0"""
SQL["coco_ap_ar"] = "SELECT * FROM summary"
SQL["coco_ap_by_class"] = """
SELECT m.class_id, m.name AS class_name, round(coalesce(avg(a.ap), -1), 6) AS ap FROM mapping m LEFT JOIN average_precision a ON a.class_id = m.class_id AND a.area_no = 0 GROUP BY ALL"""
SQL["per_class_metrics"] = "SELECT * FROM class_report"
PARTS["kept"] = "SELECT * FROM converted WHERE score >= 0.25::DOUBLE"
PARTS["best_box"] = """
SELECT image_id, det_id, gt_id, true_class, predicted_class, iou FROM (
  SELECT *, row_number() OVER (PARTITION BY image_id, det_id ORDER BY iou DESC, gt_id) AS rn FROM (
    SELECT *, ow * oh / (dw * dh + gw * gh - ow * oh) AS iou FROM (
      SELECT k.image_id, k.det_id, g.gt_id, g.class_id AS true_class, k.class_id AS predicted_class, k.w AS dw, k.h AS dh, g.w AS gw, g.h AS gh,
        least(k.x + k.w, g.x + g.w) - greatest(k.x, g.x) AS ow, least(k.y + k.h, g.y + g.h) - greatest(k.y, g.y) AS oh FROM kept k JOIN gt g USING (image_id))
    WHERE ow > 0 AND oh > 0) WHERE iou > 0.45::DOUBLE) WHERE rn = 1"""
PARTS["best_pair"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, gt_id ORDER BY iou DESC, det_id) AS rn2 FROM best_box) WHERE rn2 = 1"""
PARTS["cells"] = """
SELECT true_class, predicted_class, count(*) AS n FROM best_pair GROUP BY ALL
UNION ALL SELECT class_id, -1, count(*) FROM gt WHERE (image_id, gt_id) NOT IN (SELECT (image_id, gt_id) FROM best_pair) GROUP BY ALL
UNION ALL SELECT -1, class_id, count(*) FROM kept WHERE (image_id, det_id) NOT IN (SELECT (image_id, det_id) FROM best_pair) GROUP BY ALL"""
SQL["confusion_matrix"] = "SELECT *, round(n / sum(n) OVER (PARTITION BY true_class), 6) AS share FROM cells"
SQL["score_histogram"] = """
SELECT class_id, CAST(least(floor(score * 20), 19) AS INT) AS band, count(*) AS detections FROM converted GROUP BY ALL"""
SQL["metrics_comparison"] = """
SELECT metric, a.value AS label_value, b.value AS coco_value, round(a.value - b.value, 4) AS difference FROM (
  SELECT 'AP@[0.50:0.95]' AS metric, round(avg(map50_95), 4) AS value FROM class_report UNION ALL SELECT 'AP@0.50', round(avg(map50), 4) FROM class_report
  UNION ALL SELECT 'recall', round(avg(recall), 4) FROM class_report) a FULL JOIN (SELECT metric, round(value, 4) AS value FROM summary) b USING (metric)"""

# ---- streaming and prediction ----
SQL["stream_moving_fps"] = "SELECT source_id, event_id, frame_index, instantaneous_fps, moving_average_fps FROM rates"
SQL["stream_class_counts"] = "SELECT source_id, class_name, CAST(sum(detection_count) AS BIGINT) AS detections FROM fx_frames GROUP BY ALL"
_WINDOWS = """
SELECT date_trunc('hour', frame_ts) AS window_start, count(*) AS frames, CAST(sum(detection_count) AS BIGINT) AS detections, round(avg(inference_ms), 9) AS mean_inference_ms FROM fx_frames GROUP BY 1"""
SQL["stream_window_rate"] = """
SELECT 'window' AS kind, date_trunc('hour', frame_ts) AS window_start, count(*) AS frames, CAST(sum(detection_count) AS BIGINT) AS detections, round(avg(inference_ms), 9) AS mean_inference_ms
FROM arrivals WHERE NOT late GROUP BY 2
UNION ALL SELECT 'late', NULL, count(*), NULL, NULL FROM arrivals WHERE late"""
PARTS["arrivals"] = """
SELECT *, event_id % 50 = 7 AND frame_ts < (SELECT min(frame_ts) + (max(frame_ts) - min(frame_ts)) / 2 FROM fx_frames) AS late FROM fx_frames"""
SQL["window_rate"] = _WINDOWS
SQL["stream_result_ingest"] = """
SELECT concat('source_', lpad(CAST(source_id AS VARCHAR), 12, '0')) AS result_id, 'video' AS task_type, processed_frames, total_detections FROM videos"""
SQL["batch_predict"] = """
SELECT vec_id, label, p.class_id, round(score + j, 4) AS confidence, CAST(j AS DOUBLE) AS x1, round(CAST(embedding[j + 1] AS DOUBLE), 4) AS y1, j + 1.5::DOUBLE AS x2,
  round(CAST(embedding[j + 1] AS DOUBLE) + 2, 4) AS y2, coalesce(m.name, CAST(p.class_id AS VARCHAR)) AS class_name
FROM (SELECT *, CAST((label * 7 + j * 13) % 90 AS BIGINT) AS class_id FROM (SELECT *, unnest(range(0, label % 5)) AS j,
  list_sum([CAST(embedding[i] AS DOUBLE) * (CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) for i in range(1, len(embedding) + 1)]) AS score FROM embeddings)) p
LEFT JOIN mapping m ON m.class_id = p.class_id"""
SQL["detections_explode"] = """
SELECT CAST(p.class_id AS BIGINT) AS class_id, p.image_id, p.score AS confidence, p.x AS x1, p.y AS y1, p.x + p.w AS x2, p.y + p.h AS y2, coalesce(m.name, CAST(p.class_id AS VARCHAR)) AS class_name
FROM fx_predictions p LEFT JOIN mapping m ON m.class_id = p.class_id"""


def _needed(text: str, found: dict[str, None], own: str = "") -> None:
    for name in re.findall(r"\b(?:FROM|JOIN) (\w+)", text):
        if name in PARTS and name not in found and name != own:
            _needed(PARTS[name], found, name)
            found.setdefault(name)


def compose(body: str) -> str:
    """The query with the common table expressions it needs, in order of use."""
    found: dict[str, None] = {}
    _needed(body, found)
    if not found:
        return body
    recursive = "RECURSIVE " if {"walk", "picks"} & set(found) else ""
    kept = {"candidates", "matches", "ranked", "gt", "reduced", "cumulated", "average_precision", "levels"}
    parts = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in kept else ''}({PARTS[name]})" for name in found
    )
    return f"WITH {recursive}{parts}\n{body}"


def all_sql() -> dict[str, str]:
    return {name: compose(body) for name, body in SQL.items()}
