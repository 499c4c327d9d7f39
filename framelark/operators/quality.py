"""Validation and statistics of label files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.functions import text
from framelark.functions.geometry import fixed
from framelark.operators.scale import computed_once

# Fixed limits of the label checks.
TINY = 0.001
PIXEL_RANGE = 1000
COORD_TOLERANCE = 1e-3


def check_label_lines(lines: DataFrame, num_classes=None, fix=False) -> DataFrame:
    """Check every label line; the first failing check decides its error.

    lines: stem, line_num, line. Adds class_id, error, the flags warn_class, warn_center, warn_size and
    warn_tiny, and fixed_line (NULL for invalid lines). With `fix`, center or size pairs out of range
    but within (0, 1000] are taken as pixels and divided by 1000. Not-a-number tokens are format errors.
    """
    p = text.tokens(F.col("line"))
    rows = computed_once(lines.filter(F.length(F.trim("line")) > 0), {"_p": p})
    num = lambda i: text.as_float(F.get("_p", F.lit(i)))
    rows = computed_once(rows, {
        "n_tokens": F.size("_p"), "class_id": text.as_int(F.get("_p", F.lit(0))),
        "xc": num(1), "yc": num(2), "w": num(3), "h": num(4),
    })
    off = lambda a, b: ~F.col(a).between(0, 1) | ~F.col(b).between(0, 1)
    px = lambda c: (F.col(c) > 0) & (F.col(c) <= PIXEL_RANGE)
    repair = F.lit(bool(fix))
    bad_number = F.greatest(*[F.col(c).isNull() for c in ("class_id", "xc", "yc", "w", "h")])
    rows = rows.withColumns({
        "_fc": off("xc", "yc") & px("xc") & px("yc") & repair,
        "_fs": off("w", "h") & px("w") & px("h") & repair,
    })
    error = (
        F.when(F.col("n_tokens") != 5, "tokens")
        .when(bad_number, "number")
        .when(F.col("class_id") < 0, "negative_class")
        .when(off("xc", "yc") & ~F.col("_fc"), "center")
        .when(off("w", "h") & ~F.col("_fs"), "size")
    )
    rows = computed_once(rows, {"error": error})
    scale = lambda c, flag: F.when(F.col(flag), F.col(c) / PIXEL_RANGE).otherwise(F.col(c))
    rows = rows.withColumns({
        "xc": scale("xc", "_fc"), "yc": scale("yc", "_fc"), "w": scale("w", "_fs"), "h": scale("h", "_fs"),
    })
    # A warning counts when its check was reached, also on lines that fail a later one.
    reached = F.coalesce(~F.col("error").isin("tokens", "number", "negative_class"), F.lit(True))
    past_center = reached & ~F.coalesce(F.col("error") == "center", F.lit(False))
    ok = F.col("error").isNull()
    yes = lambda c: F.coalesce(c, F.lit(False))
    rewritten = F.when(
        F.col("_fc") | F.col("_fs"),
        F.concat_ws(" ", F.col("class_id").cast("string"), *[fixed(F.col(c)) for c in ("xc", "yc", "w", "h")]),
    ).otherwise(F.trim("line"))
    return rows.withColumns({
        "warn_class": yes(reached & (F.lit(num_classes).cast("long") <= F.col("class_id"))),
        "warn_center": yes(past_center & F.col("_fc")),
        "warn_size": yes(ok & F.col("_fs")),
        "warn_tiny": yes(ok & ((F.col("w") < TINY) | (F.col("h") < TINY))),
        "fixed_line": F.when(ok, rewritten),
    }).drop("_p", "_fc", "_fs")


def label_file_report(checked: DataFrame) -> DataFrame:
    """Per file: validity, objects, counts of errors and warnings."""
    warns = ("warn_class", "warn_center", "warn_size", "warn_tiny")
    return checked.groupBy("stem").agg(
        (F.count("error") == 0).alias("valid"),
        F.count_if(F.col("error").isNull()).alias("objects"),
        F.count("error").alias("errors"),
        sum((F.sum(F.col(w).cast("int")) for w in warns[1:]), F.sum(F.col(warns[0]).cast("int"))).alias("warnings"),
    )


def label_messages(checked: DataFrame) -> DataFrame:
    """One row per error or warning: stem, line_num, severity, code."""
    row = lambda sev, code: F.struct(F.lit(sev).alias("severity"), code.alias("code"))
    found = F.array(
        F.when(F.col("error").isNotNull(), row("error", F.col("error"))),
        *[F.when(F.col(f"warn_{k}"), row("warning", F.lit(k))) for k in ("class", "center", "size", "tiny")],
    )
    return checked.select("stem", "line_num", F.explode(F.array_compact(found)).alias("m")).select("stem", "line_num", "m.*")


def report_head(messages: DataFrame, k=10, by="severity", order=("stem", "line_num", "code")) -> DataFrame:
    """First k messages per category with the number left over.

    The row-number filter is a top-k per category, so each task passes on at most k rows of it.
    """
    from pyspark.sql import Window

    top = messages.withColumn("rn", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("rn") <= k)
    total = messages.groupBy(by).agg(F.greatest(F.count("*") - k, F.lit(0)).alias("more"))
    return top.join(total, by)


def check_seg_lines(lines: DataFrame, images: DataFrame, n_classes: int) -> DataFrame:
    """All violations of polygon labels: stem, line_num (NULL for a missing file), code.

    lines: stem, line_num, line; images: stem, has_file (a file without lines is fine).
    """
    p = text.tokens(F.col("line"))
    rows = computed_once(lines.filter(F.length(F.trim("line")) > 0), {"_p": p})
    cls = text.as_int(F.get("_p", F.lit(0)))
    coords = F.slice("_p", 2, F.greatest(F.size("_p") - 1, F.lit(0)))
    n = F.size("_p") - 1
    vals = F.transform(coords, text.as_float)
    code = (
        F.when(cls.isNull(), "class_not_int")
        .when((cls < 0) | (cls >= n_classes), "class_range")
        .when((n < 6) | (n % 2 != 0), "coord_count")
        .when(F.exists(vals, lambda v: v.isNull()), "coord_not_float")
        .when(F.exists(vals, lambda v: (v < -COORD_TOLERANCE) | (v > 1 + COORD_TOLERANCE)), "coord_range")
    )
    bad = rows.select("stem", "line_num", code.alias("code")).filter("code is not null")
    missing = images.filter("not has_file").select("stem", F.lit(None).cast("int").alias("line_num"), F.lit("missing_file").alias("code"))
    return bad.unionByName(missing)


def first_violation(violations: DataFrame) -> DataFrame:
    """The violation a strict check would stop at: smallest file, then line."""
    return violations.agg(F.min(F.struct("stem", F.coalesce("line_num", F.lit(0)).alias("line_num"), "code")).alias("v")).select("v.*")


def require_valid(violations: DataFrame) -> None:
    row = first_violation(violations).first()
    if row is not None and row["stem"] is not None:
        raise ValueError(f"{row['stem']}:{row['line_num']}: {row['code']}")


def class_distribution(objects: DataFrame, num_classes=None) -> DataFrame:
    """Objects per class id with zero rows up to the highest id (or the given class count)."""
    n = objects.groupBy("class_id").agg(F.count("*").alias("n"))
    last = n.agg(F.max("class_id").alias("top")).first()["top"]
    every = max(-1 if last is None else int(last), (num_classes or 0) - 1) + 1
    top = objects.sparkSession.range(every).select(F.col("id").cast("int").alias("class_id"))
    return top.join(n, "class_id", "left").select("class_id", F.coalesce("n", F.lit(0)).alias("n"))


def dataset_statistics(lines: DataFrame, files: DataFrame, names: DataFrame) -> DataFrame:
    """Per split one `all` row and one row per class.

    lines: split, stem, line; files: split, stem (every label file, empty ones too); names: class_id, name.
    Lines need five tokens or more; "1.0" counts as class 1.
    """
    p = text.tokens(F.col("line"))
    obj = computed_once(computed_once(lines, {"_p": p}).filter(F.size("_p") >= 5), {"class_id": text.as_float(F.get("_p", F.lit(0))).cast("int")})
    obj = obj.select("split", "stem", "class_id").filter("class_id is not null")
    # Collapsing to (split, file, class) first keeps the distinct counts small and free of hot groups.
    per_file = obj.groupBy("split", "stem", "class_id").agg(F.count("*").alias("n"))
    cls = per_file.groupBy("split", "class_id").agg(F.sum("n").alias("instances"), F.count("*").alias("images"))
    labeled = per_file.groupBy("split", "stem").agg(F.sum("n").alias("n")).groupBy("split").agg(
        F.sum("n").alias("instances"), F.count("*").alias("labeled")
    )
    total = files.groupBy("split").agg(F.count("*").alias("files")).join(labeled, "split", "left").select(
        "split", "files", F.coalesce("labeled", F.lit(0)).alias("labeled"), F.coalesce("instances", F.lit(0)).alias("total")
    )
    pct = lambda a, b: F.when(b > 0, a * 100.0 / b).otherwise(F.lit(0.0))
    per = cls.join(total, "split").join(names, "class_id", "left").select(
        "split", F.coalesce("name", F.concat(F.lit("class_"), F.col("class_id"))).alias("class"), "files",
        F.lit(None).cast("long").alias("background"), "instances",
        pct(F.col("instances"), F.col("total")).alias("instances_pct"), "images",
        pct(F.col("images"), F.col("files")).alias("images_pct"),
        F.when(F.col("images") > 0, F.col("instances") / F.col("images")).otherwise(F.lit(0.0)).alias("avg_per_image"),
    )
    every = total.select(
        "split", F.lit("all").alias("class"), "files", (F.col("files") - F.col("labeled")).alias("background"),
        F.col("total").alias("instances"), F.when(F.col("total") > 0, 100.0).otherwise(F.lit(0.0)).alias("instances_pct"),
        F.col("labeled").alias("images"), pct(F.col("labeled"), F.col("files")).alias("images_pct"),
        F.when(F.col("labeled") > 0, F.col("total") / F.col("labeled")).otherwise(F.lit(0.0)).alias("avg_per_image"),
    )
    return every.unionByName(per)


def image_statistics(images: DataFrame, objects: DataFrame) -> DataFrame:
    """One row: images, with and without labels, objects, classes, mean width and height.

    images: image_id, width, height; objects: image_id, class_id.
    """
    per = objects.groupBy("image_id").agg(F.count("*").alias("n"))
    return images.join(per, "image_id", "left").agg(
        F.count("*").alias("images"), F.count("n").alias("with_labels"), F.count_if(F.col("n").isNull()).alias("without_labels"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("objects"), F.avg("width").alias("avg_width"), F.avg("height").alias("avg_height"),
    )


def split_statistics(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Images and labels per split with the share of all images. images: image_id, split; labels: image_id."""
    has = labels.select("image_id").distinct().withColumn("_has", F.lit(1))
    per = images.join(has, "image_id", "left").groupBy("split").agg(F.count("*").alias("images"), F.count("_has").alias("labels"))
    total = images.agg(F.count("*")).scalar()
    return per.select("split", "images", "labels", (F.col("images") * 100.0 / total).alias("share"))


def image_label_mismatch(images: DataFrame, labels: DataFrame, key="image_id") -> DataFrame:
    """Keys on one side only: key, side ("no_label" or "no_image")."""
    a = images.select(key).distinct().withColumn("_i", F.lit(1))
    b = labels.select(key).distinct().withColumn("_l", F.lit(1))
    return a.join(b, key, "full_outer").filter("_i is null or _l is null").select(
        key, F.when(F.col("_l").isNull(), "no_label").otherwise("no_image").alias("side")
    )


def unlabeled_pool(sources: DataFrame, labeled: DataFrame) -> DataFrame:
    """Source ids that no labeled name starts with. sources: source_id; labeled: name."""
    done = labeled.select(text.source_id(F.col("name")).alias("source_id")).filter("source_id is not null").distinct()
    return sources.join(done, "source_id", "left_anti")
