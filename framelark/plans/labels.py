"""Label checks, data-set statistics, sampling and summaries."""

from pyspark.sql import functions as F

from framelark.operators import quality, responses, stats
from framelark.plans.projections import _CLASSES, _LABELS, matches_sql
from framelark.plans.registry import query, r6

_TOK = "regexp_split_to_array(trim(line), '\\s+')"
_F = "CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST({t} AS DOUBLE) END"
_CHECK = dict(
    parsed=f"""SELECT stem, line_num, line, tok, CASE WHEN regexp_full_match(tok[1], '[+-]?[0-9]+') THEN TRY_CAST(tok[1] AS BIGINT) END AS cls,
        {_F.format(t='tok[2]')} AS xc, {_F.format(t='tok[3]')} AS yc, {_F.format(t='tok[4]')} AS w, {_F.format(t='tok[5]')} AS h
      FROM (SELECT *, {_TOK} AS tok FROM fx_label_line WHERE trim(line) <> '')""",
    flags="""SELECT *, (xc < 0 OR xc > 1 OR yc < 0 OR yc > 1) AS oc, (w < 0 OR w > 1 OR h < 0 OR h > 1) AS os,
        (xc > 0 AND xc <= 1000 AND yc > 0 AND yc <= 1000) AS pc, (w > 0 AND w <= 1000 AND h > 0 AND h <= 1000) AS ps FROM parsed""",
)


def _errors(fix):
    c, s = ("oc AND NOT pc", "os AND NOT ps") if fix else ("oc", "os")
    return f"""SELECT *, CASE WHEN len(tok) <> 5 THEN 'tokens' WHEN cls IS NULL OR xc IS NULL OR yc IS NULL OR w IS NULL OR h IS NULL THEN 'number'
        WHEN cls < 0 THEN 'negative_class' WHEN {c} THEN 'center' WHEN {s} THEN 'size' END AS error FROM flags"""


@query("validate_labels", """
    SELECT stem, count(error) = 0 AS valid, count(*) FILTER (error IS NULL) AS objects, count(error) AS errors,
      (count(*) FILTER (cls >= 4 AND (error IS NULL OR error IN ('center', 'size'))) + count(*) FILTER (error IS NULL AND (w < 0.001 OR h < 0.001)))::BIGINT AS warnings
    FROM checked GROUP BY stem""", **_CHECK, checked=_errors(False))
def _(t):
    return quality.label_file_report(quality.check_label_lines(t.fx_label_line, num_classes=4))


@query("label_messages", """
    SELECT stem, line_num, 'error' AS severity, error AS code FROM checked WHERE error IS NOT NULL
    UNION ALL SELECT stem, line_num, 'warning', 'tiny' FROM checked WHERE error IS NULL AND (w < 0.001 OR h < 0.001)""",
       **_CHECK, checked=_errors(False))
def _(t):
    return quality.label_messages(quality.check_label_lines(t.fx_label_line))


@query("fix_labels", """
    SELECT stem, line_num, CASE WHEN oc OR os THEN cls || ' ' || printf('%.6f', CASE WHEN oc THEN xc / 1000 ELSE xc END) || ' ' || printf('%.6f', CASE WHEN oc THEN yc / 1000 ELSE yc END)
      || ' ' || printf('%.6f', CASE WHEN os THEN w / 1000 ELSE w END) || ' ' || printf('%.6f', CASE WHEN os THEN h / 1000 ELSE h END) ELSE trim(line) END AS line
    FROM checked WHERE error IS NULL""", **_CHECK, checked=_errors(True))
def _(t):
    got = quality.check_label_lines(t.fx_label_line, fix=True).filter("error is null")
    return got.select("stem", "line_num", F.col("fixed_line").alias("line"))


@query("validate_seg_dataset", f"""
    SELECT stem, line_num, CASE WHEN cls IS NULL THEN 'class_not_int' WHEN cls < 0 OR cls >= 4 THEN 'class_range'
        WHEN len(tok) - 1 < 6 OR (len(tok) - 1) % 2 <> 0 THEN 'coord_count'
        WHEN len(list_filter(nums, lambda v: v IS NULL)) > 0 THEN 'coord_not_float'
        WHEN len(list_filter(nums, lambda v: v < -1e-3 OR v > 1 + 1e-3)) > 0 THEN 'coord_range' END AS code
    FROM (SELECT stem, line_num, tok, cls, list_transform(tok[2:], lambda x: TRY_CAST(x AS DOUBLE)) AS nums FROM parsed)
    WHERE NOT coalesce(cls >= 0 AND cls < 4 AND len(tok) - 1 >= 6 AND (len(tok) - 1) % 2 = 0
      AND len(list_filter(nums, lambda v: v IS NULL OR v < -1e-3 OR v > 1 + 1e-3)) = 0, false)
    UNION ALL SELECT image_id::VARCHAR, NULL, 'missing_file' FROM fx_image WHERE image_id NOT IN (SELECT image_id FROM fx_gt)""", **_CHECK)
def _(t):
    files = t.fx_gt.select("image_id").distinct().withColumn("f", F.lit(True))
    images = t.fx_image.join(files, "image_id", "left").select(
        F.col("image_id").cast("string").alias("stem"), F.col("f").isNotNull().alias("has_file"))
    return quality.check_seg_lines(t.fx_label_line, images, 4)


@query("class_distribution", """
    SELECT c::INT AS class_id, count(p.pred_id) AS n FROM (SELECT unnest(range((SELECT greatest(max(category_id), 6) FROM fx_pred) + 1)) AS c)
    LEFT JOIN fx_pred p ON p.category_id = c GROUP BY c""")
def _(t):
    return quality.class_distribution(t.fx_pred.select(F.col("category_id").alias("class_id")), 7)


_SPLITS = "SELECT i.split, i.image_id::VARCHAR AS stem FROM fx_image i"


@query("dataset_statistics", f"""
    SELECT split, class, files, background, instances, round(instances_pct, 6) AS instances_pct, images, round(images_pct, 6) AS images_pct, round(avg_per_image, 6) AS avg_per_image FROM (
      SELECT split, 'all' AS class, files, files - labeled AS background, total AS instances, CASE WHEN total > 0 THEN 100.0::DOUBLE ELSE 0 END AS instances_pct,
        labeled AS images, labeled * 100.0::DOUBLE / files AS images_pct, total / labeled::DOUBLE AS avg_per_image FROM tot
      UNION ALL SELECT o.split, coalesce(r_name, 'class_' || cls), files, NULL, count(*), count(*) * 100.0::DOUBLE / total, count(DISTINCT stem),
        count(DISTINCT stem) * 100.0::DOUBLE / files, count(*) / count(DISTINCT stem)::DOUBLE
      FROM obj o JOIN tot ON tot.split = o.split LEFT JOIN region ON r_regionkey = cls GROUP BY o.split, cls, r_name, files, total)""",
       filesx=_SPLITS,
       obj=f"""SELECT f.split, l.stem, trunc({_F.format(t='tok[1]')})::INT AS cls FROM (SELECT *, {_TOK} AS tok FROM fx_label_line) l JOIN filesx f ON f.stem = l.stem
              WHERE len(tok) >= 5 AND {_F.format(t='tok[1]')} IS NOT NULL""",
       tot="""SELECT f.split, count(DISTINCT f.stem) AS files, count(DISTINCT o.stem) AS labeled, count(o.stem) AS total
              FROM filesx f LEFT JOIN obj o ON o.stem = f.stem GROUP BY f.split""")
def _(t):
    files = t.fx_image.select("split", F.col("image_id").cast("string").alias("stem"))
    names = t.region.select(F.col("r_regionkey").alias("class_id"), F.col("r_name").alias("name"))
    got = quality.dataset_statistics(t.fx_label_line.join(files, "stem"), files, names)
    for c in ("instances_pct", "images_pct", "avg_per_image"):
        got = got.withColumn(c, F.round(c, 6))
    return got


@query("image_statistics", """
    SELECT count(*) AS images, count(n) AS with_labels, count(*) FILTER (n IS NULL) AS without_labels, sum(n)::BIGINT AS objects,
      avg(width) AS avg_width, avg(height) AS avg_height
    FROM fx_image i LEFT JOIN (SELECT image_id, count(*) AS n FROM fx_gt GROUP BY 1) g ON g.image_id = i.image_id""")
def _(t):
    return quality.image_statistics(t.fx_image, t.fx_gt)


@query("split_statistics", """
    SELECT split, count(*) AS images, count(g.image_id) AS labels, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM fx_image), 6) AS share
    FROM fx_image i LEFT JOIN (SELECT DISTINCT image_id FROM fx_gt) g ON g.image_id = i.image_id GROUP BY split""")
def _(t):
    return quality.split_statistics(t.fx_image, t.fx_gt).withColumn("share", F.round("share", 6))


@query("image_label_mismatch", """
    SELECT coalesce(i.image_id, g.image_id) AS image_id, CASE WHEN g.image_id IS NULL THEN 'no_label' ELSE 'no_image' END AS side
    FROM fx_image i FULL JOIN (SELECT DISTINCT image_id FROM fx_gt) g ON g.image_id = i.image_id WHERE i.image_id IS NULL OR g.image_id IS NULL""")
def _(t):
    return quality.image_label_mismatch(t.fx_image, t.fx_gt)


@query("unlabeled_pool", """SELECT timestamp_ns::VARCHAR AS source_id FROM fx_image i WHERE NOT EXISTS (SELECT 1 FROM fx_gt g WHERE g.image_id = i.image_id)""")
def _(t):
    from framelark.functions import text
    sources = t.fx_image.select(text.source_id(F.col("file_name")).alias("source_id"))
    # Labeled names are augmented copies: <source>_aug<k>.jpg.
    labeled = t.fx_gt.join(t.fx_image, "image_id").select(
        F.concat(F.col("timestamp_ns").cast("string"), F.lit("_aug"), F.col("category_id"), F.lit(".jpg")).alias("name"))
    return quality.unlabeled_pool(sources, labeled)


@query("sync_by_name", """SELECT r.file_name FROM fx_frame r WHERE side = 'right' AND EXISTS (SELECT 1 FROM fx_frame l WHERE l.side = 'left' AND l.file_name = r.file_name)""")
def _(t):
    from framelark.operators.frames import sync_by_name
    f = t.fx_frame
    return sync_by_name(f.filter("side = 'left'"), f.filter("side = 'right'"))[0].select("file_name")


# --- summaries -----------------------------------------------------------------------------------


@query("track_summary", """SELECT (SELECT count(*) FROM fx_image) AS images, count(*) AS annotations, count(DISTINCT category_id) AS tracks,
    count(*) FILTER ((x2 - x1) * (y2 - y1) >= 1000) AS with_mask FROM fx_gt""")
def _(t):
    anns = t.fx_gt.select(F.col("category_id").alias("track_id"), ((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")) >= 1000).alias("has_mask"))
    return stats.track_summary(anns, t.fx_image)


@query("track_lengths", "SELECT video_id, ann_id % 5 AS track_id, count(*) AS boxes, min(frame_idx) AS first_frame, max(frame_idx) AS last_frame FROM fx_keybox GROUP BY ALL")
def _(t):
    return stats.track_lengths(t.fx_keybox.withColumn("track_id", F.col("ann_id") % 5), ["video_id"])


@query("tracks_per_frame", "SELECT video_id, frame_idx, count(DISTINCT ann_id % 5) AS tracks FROM fx_keybox GROUP BY ALL")
def _(t):
    return stats.tracks_per_frame(t.fx_keybox.withColumn("track_id", F.col("ann_id") % 5), ["video_id"])


@query("latency_profile", """
    SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max, round(sum(value), 4) AS total,
      round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, round(1 / avg(value), 6) AS per_second
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events) WHERE i > 10 GROUP BY event_type""")
def _(t):
    p = stats.latency_profile(t.events, ["event_type"], ["ts", "event_id"], "value", 10)
    for c in ("mean", "p50", "p95", "p99", "per_second"):
        p = p.withColumn(c, F.round(c, 6))
    return p.withColumn("total", F.round("total", 4))


@query("frame_reduction", """
    SELECT side AS camera, count(*) AS raw, count(*) FILTER (i % 5 = 0) AS sampled, count(*) FILTER (i % 20 = 0) AS keyframe, count(*) FILTER (i % 20 = 0 AND k IS NOT NULL) AS review
    FROM (SELECT f.side, row_number() OVER (PARTITION BY f.side ORDER BY timestamp_ns) - 1 AS i, p.timestamp_ns AS k FROM fx_frame f
          LEFT JOIN (SELECT timestamp_ns FROM fx_frame GROUP BY 1 HAVING count(*) = 2) p USING (timestamp_ns)) GROUP BY side""")
def _(t):
    from framelark.operators import frames
    from framelark.operators.scale import ordinal
    raw = ordinal(t.fx_frame.withColumnRenamed("side", "camera"), ["camera"], ["timestamp_ns"], "frame_idx")
    sampled = frames.keyframes(raw, ["camera"], 5)
    key = frames.keyframes(raw, ["camera"], 20)
    both = t.fx_frame.groupBy("timestamp_ns").count().filter("count = 2")
    return stats.frame_reduction(raw, {"sampled": sampled, "keyframe": key, "review": key.join(both, "timestamp_ns", "left_semi")})


@query("labeling_summary", f"""
    SELECT count(DISTINCT image_id) FILTER (label IS NOT NULL) AS ok, count(*) FILTER (label IS NULL) AS failed, count(*) FILTER (label IS NULL) AS parse_errors,
      (SELECT count(DISTINCT CASE WHEN label IN ('Exit_Sign') THEN 1 WHEN label = 'ceiling light' THEN 2 ELSE 3 END) FROM ({_LABELS}) WHERE {' OR '.join(matches_sql('label', repr(c)) for c in _CLASSES)} AND label IS NOT NULL) AS classes,
      count(*) FILTER (label = 'robot') AS dropped_labels
    FROM ({_LABELS})""")
def _(t):
    parsed = responses.parse_responses(t.fx_vlm)
    items = responses.explode_detections(parsed, ["image_id"])
    kept, dropped = responses.canonicalize_labels(items, _CLASSES)
    return stats.labeling_summary(parsed.select(F.col("parse_error").isNull().alias("success"), "parse_error"), kept, dropped)


@query("trial_leaderboard", """
    SELECT p_brand AS study, arg_max(p_partkey, struct_pack(s := p_retailprice, i := -p_partkey)) FILTER (p_size > 10 AND p_type NOT LIKE 'S%') AS best_trial,
      max(p_retailprice) FILTER (p_size > 10 AND p_type NOT LIKE 'S%') AS best_score, count(*) AS trials, count(*) FILTER (p_size > 5) AS completed
    FROM part GROUP BY p_brand""")
def _(t):
    trials = t.part.select(
        F.col("p_brand").alias("study"), F.col("p_partkey").alias("trial_id"),
        F.when(~F.col("p_type").startswith("S"), F.col("p_retailprice")).alias("score"),
        F.when(F.col("p_size") > 10, "success").when(F.col("p_size") > 5, "failed").otherwise("running").alias("status"))
    return stats.trial_leaderboard(trials, ["study"])


@query("group_by_size", "SELECT width, height, count(*) AS n FROM fx_image GROUP BY ALL")
def _(t):
    return stats.group_by_size(t.fx_image)


_DISP = """SELECT user_id, CASE WHEN event_id % 17 = 0 THEN value ELSE value / 40 END AS dx, (event_id % 19) * 0.3::DOUBLE AS dy,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE (event_id % 11) * 0.12::DOUBLE END AS fb_error FROM events"""


@query("consensus_displacement", """
    SELECT user_id, round(median(dx) FILTER (ok), 6) AS dx, round(median(dy) FILTER (ok), 6) AS dy, count(*) FILTER (ok) AS kept FROM (
      SELECT d.*, coalesce(fb_error < 1.0 AND abs(dx - mx) <= greatest(2.0, 3 * ax) AND abs(dy - my) <= greatest(2.0, 3 * ay), false) AS ok
      FROM disp d JOIN med USING (user_id) JOIN mad USING (user_id)) GROUP BY user_id""",
       disp=_DISP, med="SELECT user_id, median(dx) AS mx, median(dy) AS my FROM disp GROUP BY 1",
       mad="SELECT user_id, median(abs(dx - mx)) AS ax, median(abs(dy - my)) AS ay FROM disp JOIN med USING (user_id) GROUP BY 1")
def _(t):
    pts = t.events.select(
        "user_id", F.when(F.col("event_id") % 17 == 0, F.col("value")).otherwise(F.col("value") / 40).alias("dx"),
        ((F.col("event_id") % 19) * F.lit(0.3)).alias("dy"),
        F.when(F.col("event_id") % 7 != 0, (F.col("event_id") % 11) * F.lit(0.12)).alias("fb_error"))
    got = stats.consensus_displacement(pts, ["user_id"])
    return got.select("user_id", r6("dx", "dx"), r6("dy", "dy"), "kept")


def _plane_sql():
    """Parts that fit planes round by round; the direction of least variance in closed form."""
    parts = {
        "pts": """SELECT l_returnflag AS cloud, l_quantity::DOUBLE AS x, l_extendedprice / 1000.0::DOUBLE AS y,
            0.03::DOUBLE * l_quantity - 0.02::DOUBLE * (l_extendedprice / 1000.0::DOUBLE) + l_discount + CASE WHEN l_tax > 0.04 THEN l_tax * 100 ELSE 0 END AS z FROM lineitem""",
        "cur0": f"SELECT p.* FROM pts p JOIN (SELECT cloud, quantile_cont(z, {stats.LOW_SLICE}) AS lim FROM pts GROUP BY 1) USING (cloud) WHERE z <= lim"}
    for i in range(stats.FIT_ROUNDS):
        parts[f"mom{i}"] = f"""SELECT cloud, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz, covar_pop(x, x) AS xx, covar_pop(x, y) AS xy, covar_pop(x, z) AS xz,
            covar_pop(y, y) AS yy, covar_pop(y, z) AS yz, covar_pop(z, z) AS zz FROM cur{i} GROUP BY 1"""
        parts[f"eig{i}"] = f"""SELECT *, q + 2 * p * cos(acos(greatest(-1, least(1, ((xx - q) * ((yy - q) * (zz - q) - yz * yz) - xy * (xy * (zz - q) - yz * xz) + xz * (xy * yz - (yy - q) * xz)) / (p * p * p) / 2))) / 3 + 2 * pi() / 3) AS v
            FROM (SELECT *, sqrt(((xx - q) * (xx - q) + (yy - q) * (yy - q) + (zz - q) * (zz - q) + 2 * (xy * xy + xz * xz + yz * yz)) / 6) AS p FROM (SELECT *, (xx + yy + zz) / 3 AS q FROM mom{i}))"""
        parts[f"fit{i}"] = f"""SELECT cloud, cx, cy, cz, nx / s AS nx, ny / s AS ny, nz / s AS nz FROM (SELECT *, sqrt(nx * nx + ny * ny + nz * nz) * CASE WHEN nz < 0 THEN -1 ELSE 1 END AS s FROM (
            SELECT cloud, cx, cy, cz, xy * yz - xz * (yy - v) AS nx, xz * xy - (xx - v) * yz AS ny, (xx - v) * (yy - v) - xy * xy AS nz FROM eig{i}))"""
        parts[f"cur{i + 1}"] = f"SELECT c.* FROM cur0 c JOIN fit{i} f USING (cloud) WHERE abs((x - cx) * nx + (y - cy) * ny + (z - cz) * nz) < {stats.INLIER_DIST}"
    last = stats.FIT_ROUNDS
    return f"""SELECT cloud, round(nx, 6) AS nx, round(ny, 6) AS ny, round(nz, 6) AS nz, round(degrees(acos(least(1, nz))), 6) AS tilt, inliers, degrees(acos(least(1, nz))) < {stats.LEVEL_TILT} AS level
        FROM fit{last - 1} JOIN (SELECT cloud, count(*) AS inliers FROM cur{last} GROUP BY 1) USING (cloud) WHERE inliers >= {stats.MIN_INLIERS}""", parts


_PLANE, _PLANE_PARTS = _plane_sql()


@query("ground_plane_fit", _PLANE, **_PLANE_PARTS)
def _(t):
    # Line items as points of one cloud per ship flag: a slightly tilted floor with noise and clutter above.
    x, y = F.col("l_quantity"), F.col("l_extendedprice") / 1000.0
    floor = 0.03 * x - 0.02 * y + F.col("l_discount")
    pts = t.lineitem.select(F.col("l_returnflag").alias("cloud"), x.alias("x"), y.alias("y"),
                            (floor + F.when(F.col("l_tax") > 0.04, F.col("l_tax") * 100).otherwise(0.0)).alias("z"))
    g = stats.ground_plane_fit(pts)
    return g.select("cloud", *[r6(c, c) for c in ("nx", "ny", "nz", "tilt")], "inliers", "level")


@query("annotation_coverage", """
    SELECT split, count(*) AS frames, count(b) AS boxed, round(count(b) / count(*)::DOUBLE, 6) AS coverage FROM (
      SELECT split, image_id // 2 AS frame_idx, max(CASE WHEN image_id IN (SELECT image_id FROM fx_gt) THEN 1 END) AS b FROM fx_image GROUP BY ALL) GROUP BY split""")
def _(t):
    images = t.fx_image.select("split", "image_id", F.floor(F.col("image_id") / 2).alias("frame_idx"))
    return stats.annotation_coverage(images, t.fx_gt, ["split"]).withColumn("coverage", F.round("coverage", 6))


# --- sampling ------------------------------------------------------------------------------------


@query("sample_n", "SELECT image_id FROM (SELECT image_id FROM fx_image ORDER BY md5('7:' || image_id), image_id LIMIT 1000)")
def _(t):
    return stats.sample_n(t.fx_image.select("image_id"), "image_id", 1000, seed=7)


@query("first_n", "SELECT image_id, file_name FROM (SELECT * FROM fx_image ORDER BY image_id LIMIT 500)")
def _(t):
    return stats.first_n(t.fx_image.select("image_id", "file_name"), "image_id", 500)


@query("report_head", """
    SELECT code, stem, line_num, severity, rn, greatest(n - 10, 0) AS more FROM (
      SELECT *, row_number() OVER (PARTITION BY code ORDER BY stem, line_num) AS rn, count(*) OVER (PARTITION BY code) AS n
      FROM (SELECT stem, line_num, 'error' AS severity, error AS code FROM checked WHERE error IS NOT NULL
            UNION ALL SELECT stem, line_num, 'warning', 'tiny' FROM checked WHERE error IS NULL AND (w < 0.001 OR h < 0.001))) WHERE rn <= 10""",
       **_CHECK, checked=_errors(False))
def _(t):
    messages = quality.label_messages(quality.check_label_lines(t.fx_label_line))
    return quality.report_head(messages, 10, "code", ("stem", "line_num"))


@query("random_split", """
    SELECT image_id, CASE WHEN i <= trunc(n * 0.7) THEN 'train' WHEN i <= trunc(n * 0.7) + trunc(n * 0.15) THEN 'test' ELSE 'val' END AS split FROM (
      SELECT image_id, row_number() OVER (ORDER BY md5('3:' || image_id), image_id) AS i, count(*) OVER () AS n FROM fx_image)""")
def _(t):
    return stats.random_split(t.fx_image.select("image_id"), "image_id", (0.7, 0.15, 0.15), seed=3)
