"""Combining, editing and exporting annotated image sets."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.functions.text import as_int
from framelark.operators.scale import ordinal, running

# Longest list one row of a document may hold; longer ones continue in the next document.
LIST_ROWS = 10_000


def bounded_lists(rows: DataFrame, keys, order, item, name, size=LIST_ROWS) -> DataFrame:
    """Rows of a key as sorted lists of at most `size`: keys, chunk, `name`.

    `item` is the struct to collect; `order` must be total inside the key.
    """
    keys = list(keys)
    ix = ordinal(rows.withColumn("_item", item), keys, order, "_i").withColumn("chunk", F.floor(F.col("_i") / size))
    lists = ix.groupBy(*keys, "chunk").agg(F.array_sort(F.collect_list(F.struct("_i", "_item"))).alias("_l"))
    return lists.select(*keys, "chunk", F.transform("_l", lambda x: x["_item"]).alias(name))


def _combine(images, anns, cats, by):
    """Shared renumbering of several inputs; `by` is the column naming the input."""
    names = cats.groupBy("name").agg(F.min(F.struct(by, "pos")).alias("_f"))
    new_cats = ordinal(names, [], ["_f"], "new_cat").select("name", F.col("new_cat").cast("int").alias("new_cat"))
    cat_map = cats.select(by, "category_id", "name").join(new_cats, "name").select(by, "category_id", "new_cat")
    new_images = ordinal(images, [], [by, "pos"], "new_image", start=1)
    image_map = new_images.select(by, "image_id", "new_image")
    joined = anns.join(image_map, [by, "image_id"], "left").join(cat_map, [by, "category_id"], "left")
    bad = F.col("new_image").isNull() | F.col("new_cat").isNull()
    return new_images, joined.filter(~bad), joined.filter(bad), new_cats


def _renumbered(new_images, kept, new_cats, by):
    images = new_images.drop("image_id", "pos").withColumnRenamed("new_image", "image_id")
    anns = ordinal(kept, [], [by, "pos"], "new_ann", start=1).drop("ann_id", "image_id", "category_id", "pos").withColumnsRenamed(
        {"new_ann": "ann_id", "new_image": "image_id", "new_cat": "category_id"})
    return images, anns, new_cats.select(F.col("new_cat").alias("category_id"), "name")


def combine_datasets(images: DataFrame, anns: DataFrame, cats: DataFrame, by="part"):
    """Several sets as one: (images, annotations, categories, dropped annotations per input).

    images: part, pos, image_id, file_name, side, ...; anns: part, pos, ann_id, image_id, category_id, ...;
    cats: part, pos, category_id, name. Categories merge by name in first-seen order from 0; images and
    annotations are renumbered from 1 in input order; other columns stay. Duplicate images raise.
    """
    from framelark.operators.suppress import assert_unique_images

    assert_unique_images(images)
    new_images, kept, bad, new_cats = _combine(images, anns, cats, by)
    dropped = bad.groupBy(by).agg(F.count("*").alias("dropped"))
    return *_renumbered(new_images, kept, new_cats, by), dropped


def merge_stereo(images: DataFrame, anns: DataFrame, cats: DataFrame):
    """The two sides of a session as one set; a dangling reference raises.

    Same columns as for combining, with `side` naming the input; sides go in sorted order.
    """
    new_images, kept, bad, new_cats = _combine(images, anns, cats, "side")
    lost = bad.select("side", "ann_id").take(1)
    if lost:
        raise ValueError(f"annotation {lost[0]['ann_id']} of side {lost[0]['side']} points nowhere")
    return _renumbered(new_images, kept, new_cats, "side")


def annotated_image_ids(anns: DataFrame) -> DataFrame:
    return anns.select("image_id").distinct()


def annotated_timestamps(images: DataFrame, anns: DataFrame, missing="drop") -> DataFrame:
    """Distinct times of images with boxes; a missing or zero time is dropped, or counts as 0."""
    ts = F.coalesce("timestamp_ns", F.lit(0).cast("long")).alias("timestamp_ns")
    got = images.join(annotated_image_ids(anns), "image_id", "left_semi").select(ts).distinct()
    return got.filter("timestamp_ns <> 0") if missing == "drop" else got


def union_categories(saved: DataFrame, current: DataFrame, session_has_content=True) -> DataFrame:
    """Saved categories and those current ones whose id and name are both unused.

    An empty earlier session contributes nothing.
    """
    cols = ["category_id", "name"]
    if not session_has_content or saved.isEmpty():
        return current.select(*cols)
    new = current.join(saved.select("category_id"), "category_id", "left_anti").join(saved.select("name"), "name", "left_anti")
    return saved.select(*cols).unionByName(new.select(*cols))


def resolve_labels(labels: DataFrame, cats: DataFrame) -> DataFrame:
    """Category id of label text: an existing id written as integer, else by name, else a new id.

    labels: label, pos. Output: label, category_id, created. New ids follow the highest one in order of
    first appearance.
    """
    seen = labels.groupBy("label").agg(F.min("pos").alias("pos")).withColumn("_num", as_int(F.trim("label")))
    by_id = cats.select(F.col("category_id").cast("long").alias("_num"), F.col("category_id").alias("_i")).distinct()
    by_name = cats.groupBy(F.col("name").alias("label")).agg(F.min("category_id").alias("_n"))
    # Labels that are no number would all meet in one partition.
    numbers = seen.filter("_num is not null").join(by_id, "_num", "left")
    got = numbers.unionByName(seen.filter("_num is null"), allowMissingColumns=True).join(by_name, "label", "left").withColumn("known", F.coalesce("_i", "_n"))
    top = cats.agg(F.coalesce(F.max("category_id"), F.lit(-1))).scalar()
    fresh = ordinal(got.filter("known is null").select("label", "pos"), [], ["pos", "label"], "_k", start=1).select(
        "label", (top + F.col("_k")).cast("int").alias("category_id"), F.lit(True).alias("created"))
    old = got.filter("known is not null").select("label", F.col("known").cast("int").alias("category_id"), F.lit(False).alias("created"))
    return old.unionByName(fresh)


def assemble_dataset(raw: DataFrame, augmented=None) -> DataFrame:
    """Training rows from the augmented set (or the raw one), validation and test rows raw."""
    if augmented is None:
        return raw
    return augmented.withColumn("split", F.lit("train")).unionByName(raw.filter("split <> 'train'"), allowMissingColumns=True)


def apply_edits(anns: DataFrame, cats: DataFrame, edits: DataFrame):
    """Current annotations and categories after an edit log.

    edits: seq, op, ann_id, image_id, category_id, track_id, x, y, w, h, name. Ops: add, remove, move
    (x, y), resize (x, y, w, h), set_category, set_track, delete_category (removes the boxes that have it
    at that moment), rename_category. The last edit of a field wins; removed boxes stay removed.
    """
    e = edits
    base = anns.select("ann_id", "image_id", "category_id", "track_id", "x", "y", "w", "h", F.lit(-1).cast("long").alias("seq"), F.lit("add").alias("op"))
    log = base.unionByName(e.select(*base.columns))
    last = lambda col, *ops: F.max_by(F.col(col), F.when(F.col("op").isin("add", *ops), F.col("seq")))
    state = log.filter("ann_id is not null").groupBy("ann_id").agg(
        F.max(F.when(F.col("op") == "add", F.col("image_id"))).alias("image_id"),
        last("category_id", "set_category").alias("category_id"),
        last("track_id", "set_track").alias("track_id"),
        last("x", "move", "resize").alias("x"), last("y", "move", "resize").alias("y"),
        last("w", "resize").alias("w"), last("h", "resize").alias("h"),
        F.max((F.col("op") == "remove").cast("int")).alias("gone"),
        F.max((F.col("op") == "add").cast("int")).alias("made"),
    )
    # A category holds from its edit to the next one of the same box; a deletion inside that time kills the box.
    held = log.filter(F.col("op").isin("add", "set_category") & F.col("ann_id").isNotNull())
    spans = running(held.select("ann_id", "category_id", "seq"), ["ann_id"], [F.col("seq").desc()], {"until": ("min", F.col("seq"))}, before=True)
    deletions = e.filter("op = 'delete_category'").select("category_id", F.col("seq").alias("at"))
    # A row per category with its deletions in order (edits by hand, few): boxes of a category do not meet each.
    times = deletions.groupBy("category_id").agg(F.array_sort(F.collect_list("at")).alias("times"))
    dead = F.exists("times", lambda at: (at > F.col("seq")) & (F.col("until").isNull() | (at < F.col("until"))))
    killed = spans.join(times, "category_id").filter(dead).select("ann_id").distinct()
    live = state.filter("gone = 0 and made = 1").drop("gone", "made").join(killed, "ann_id", "left_anti")
    names = e.filter("op = 'rename_category'").groupBy("category_id").agg(F.max_by("name", "seq").alias("_new"))
    out_cats = cats.join(deletions.select("category_id"), "category_id", "left_anti").join(names, "category_id", "left").select(
        "category_id", F.coalesce("_new", "name").alias("name"))
    return live, out_cats


def unsynced_filter(images: DataFrame, anns: DataFrame, discarded=None):
    """(images, annotations) of times present on both sides; discarded frames only drop out when given."""
    sides = images.select("timestamp_ns", "side").distinct().groupBy("timestamp_ns").count().filter("count >= 2")
    kept = images.join(sides.select("timestamp_ns"), "timestamp_ns", "left_semi")
    if discarded is not None:
        kept = kept.join(discarded.select("frame_idx").distinct(), "frame_idx", "left_anti")
    return kept, anns.join(kept.select("image_id"), "image_id", "left_semi")


def register_frames(images: DataFrame, frames: DataFrame) -> DataFrame:
    """One image row per (time, side): existing ids stay, unknown sizes (0) are filled in, new ids follow."""
    key = ["timestamp_ns", "side"]
    f = frames.groupBy(*key).agg(F.max("file_name").alias("_fn"), F.max("width").alias("_w"), F.max("height").alias("_h"))
    both = images.join(f, key, "full_outer")
    dim = lambda old, new: F.coalesce(F.nullif(F.col(new), F.lit(0)), F.col(old), F.lit(0))
    rows = both.select(
        *key, "image_id", F.coalesce("file_name", "_fn").alias("file_name"),
        dim("width", "_w").alias("width"), dim("height", "_h").alias("height"), F.col("image_id").isNull().alias("created"))
    top = images.agg(F.coalesce(F.max("image_id"), F.lit(0))).scalar()
    fresh = ordinal(rows.filter("created"), [], key, "_k", start=1).withColumn("image_id", top + F.col("_k")).drop("_k")
    return rows.filter("not created").unionByName(fresh.select(*rows.columns))


def pending_masks(anns: DataFrame, images: DataFrame, cats: DataFrame):
    """(boxes without a polygon with frame, side and concept; counts per frame and side)."""
    todo = anns.filter("not has_mask").join(images.select("image_id", "frame_idx", "side"), "image_id").join(
        cats, "category_id", "left").select(
        "frame_idx", F.coalesce("side", F.lit("left")).alias("side"), "ann_id", F.coalesce("name", F.lit("object")).alias("concept"))
    return todo, todo.groupBy("frame_idx", "side").agg(F.count("*").alias("boxes"))


def export_tables(images: DataFrame, anns: DataFrame, removed: DataFrame, discarded: DataFrame, marks: DataFrame, synced=False):
    """Final state of a session: (images with output position, annotations, annotated ids, annotated times).

    images: image_id, file_name, timestamp_ns, frame_idx, side; removed: ann_id; discarded and marks:
    frame_idx. With `synced`, images whose time is missing on the other side go too.
    """
    kept = images.join(discarded.select("frame_idx").distinct(), "frame_idx", "left_anti")
    if synced:
        both = images.select("timestamp_ns", "side").distinct().groupBy("timestamp_ns").count().filter("count >= 2")
        kept = kept.join(both.select("timestamp_ns"), "timestamp_ns", "left_semi")
    out = anns.join(removed.select("ann_id"), "ann_id", "left_anti").join(kept.select("image_id"), "image_id", "left_semi")
    ids = out.select("image_id").unionByName(kept.join(marks.select("frame_idx").distinct(), "frame_idx", "left_semi").select("image_id")).distinct()
    ts = F.coalesce("timestamp_ns", F.lit(0).cast("long"))
    times = kept.join(ids, "image_id", "left_semi").select(ts.alias("timestamp_ns")).distinct()
    rank = kept.withColumns({"_t": ts, "_s": F.when(F.coalesce("side", F.lit("left")) == "left", 0).otherwise(1)})
    ordered = ordinal(rank, [], ["_t", "_s", "image_id"], "position").drop("_t", "_s")
    return ordered, out, ids, times
