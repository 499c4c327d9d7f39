"""Building blocks that keep order-dependent operators safe on very large groups.

Order-dependent rules (running sums, greedy choices) are cheapest as one sorted group per key.
That is only right while each group is small, so every operator built on them first counts its
groups (`oversized`) and sends larger ones through a second, equally exact way that never holds
a whole group in one task: two-level running aggregates, grid joins and rounds of local decisions.
"""

import math
import os
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows of one group a single sorted window or array may hold. Options can be overridden per session.
WINDOW_ROWS = 2_000_000
FOLD_ROWS = 1_000


def limit_of(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(f"framelark.{name}", str(default)))


_OWNED = {}  # application: its folder


def shared_folder(spark: SparkSession) -> str:
    """The application's folder for written intermediate tables, in the cluster's checkpoint folder.

    It is deleted when the driver ends, or before by `release`. Only a local session without that setting
    falls back to a temporary folder of this machine.
    """
    app = spark.sparkContext.applicationId
    if app not in _OWNED:
        path = f"{_checkpoint_folder(spark)}/framelark-{app}"
        files, at = _files(spark, path)
        files.mkdirs(at)
        files.deleteOnExit(at)
        _OWNED[app] = path
    return _OWNED[app]


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables written so far; results not yet written out are lost with them."""
    path = _OWNED.pop(spark.sparkContext.applicationId, None)
    if path is not None:
        files, at = _files(spark, path)
        files.delete(at, True)


def _files(spark, path):
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(context._jsc.hadoopConfiguration()), at


def _checkpoint_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("framelark.scratch", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("framelark.scratch", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def cut(df: DataFrame, partition=None, codec=None) -> DataFrame:
    """Write the rows to a table in the shared folder and go on from there.

    The table survives the loss of executors, is computed once, and later steps read only the columns
    they need from it. With `partition`, a folder for each value of that column; with `codec`, packed by it.
    """
    path = scratch_path(df.sparkSession, "cut")
    writer = df.write if partition is None else df.repartition(partition).write.partitionBy(partition)
    writer.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def oversized(df: DataFrame, keys, limit: int):
    """Keys of groups with more than `limit` rows, or None when there is none.

    One pass over the key columns with map-side partial counts.
    """
    big = df.groupBy(*keys).count().filter(F.col("count") > F.lit(limit)).select(*keys)
    return None if big.isEmpty() else cut(big)


def split_by_size(df: DataFrame, keys, limit: int):
    """(rows of bounded groups, rows of oversized groups or None)."""
    big = oversized(df, keys, limit)
    if big is None:
        return df, None
    return df.join(big, keys, "left_anti"), df.join(big, keys, "left_semi")


def split_both(left: DataFrame, right: DataFrame, keys, limit: int):
    """Two sides split alike: ((left, right) bounded, (left, right) oversized or None).

    A group is oversized when either side is, so a bounded group has at most limit x limit pairs.
    """
    sides = left.select(*keys, F.lit(1).alias("_l")).unionByName(right.select(*keys, F.lit(0).alias("_l")))
    n = sides.groupBy(*keys).agg(F.sum("_l").alias("_nl"), F.sum(1 - F.col("_l")).alias("_nr"))
    big = n.filter(F.greatest("_nl", "_nr") > F.lit(limit)).select(*keys)
    if big.isEmpty():
        return (left, right), None
    big = cut(big)
    small = (left.join(big, keys, "left_anti"), right.join(big, keys, "left_anti"))
    return small, (left.join(big, keys, "left_semi"), right.join(big, keys, "left_semi"))


def filter_late(df: DataFrame, cond: Column) -> DataFrame:
    """Filter that stays above the columns it reads.

    Pushing a condition below a chain of computed columns repeats their formulas once per use. Catalyst
    pushes nothing below the partition number, which counts from 0, so it adds nothing to the condition.
    """
    return df.withColumn("_here", F.spark_partition_id()).filter((F.col("_here") < 0) | cond).drop("_here")


def computed_once(df: DataFrame, columns: dict) -> DataFrame:
    """The rows with costly columns that later steps may name any number of times.

    Catalyst puts the formula of a plain column in place of its name, once for each use. Nothing moves across a
    generator, so columns that come out of one are computed once a row.
    """
    made = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_made")
    kept = [c for c in df.columns if c not in columns]
    return df.select("*", made).select(*kept, *[F.col(f"_made.{n}").alias(n) for n in columns])


def union_all(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- running aggregates -------------------------------------------------------------------------

_FOLDS = {"sum": F.sum, "max": F.max, "min": F.min}


def running(df: DataFrame, group, order, outs, before=False, like=None) -> DataFrame:
    """Running aggregates along `order` inside `group`.

    outs: {name: ("sum" | "max" | "min", Column)}. `before=True` leaves the current row out.
    `order` must be total inside the group (columns or Columns, ascending unless `.desc()` is used).
    `like` is a cheaper table with at least the same groups and row counts, to measure group sizes on.

    Groups that fit one sorted window use it. Otherwise rows are range-partitioned by (group, order),
    aggregated inside each slice, and the totals of earlier slices are added from a small summary.
    """
    group = list(group)
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    limit = limit_of(df.sparkSession, "windowRows", WINDOW_ROWS)
    if group:
        big = oversized(df if like is None else like, group, limit) is not None
    else:
        big = True
    if not big:
        return _running_windows(df, group, order, outs, before)
    return running_in_slices(slices(df, group, order), group, order, outs, before).drop("_slice")


def _running_windows(df, keys, order, outs, before):
    end = -1 if before else Window.currentRow
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    return df.withColumns({n: _FOLDS[k](c).over(w) for n, (k, c) in outs.items()})


def slices(df: DataFrame, group, order) -> DataFrame:
    """The rows, dealt by ranges of (group, order) and written, with the number of their range as `_slice`.

    Writing keeps a row in its slice when a task is run again. Several running aggregates can share it.
    """
    return cut(df.orderBy(*group, *order).withColumn("_slice", F.spark_partition_id()))


def running_in_slices(rows: DataFrame, group, order, outs, before=False, backward=False) -> DataFrame:
    """`running` over rows with `_slice`, from the last slice to the first with `backward` (order descending then)."""
    inputs = {f"_in_{n}": c for n, (_, c) in outs.items()}
    local = {n: (k, F.col(f"_in_{n}")) for n, (k, _) in outs.items()}
    # Dealt before the inputs are added, so that only the rows themselves move.
    dealt = rows.repartition("_slice", *group)
    inside = _running_windows(dealt.withColumns(inputs), ["_slice", *group], order, local, before).drop(*inputs)
    totals = rows.withColumns(inputs).groupBy("_slice", *group).agg(
        *[_FOLDS[k](f"_in_{n}").alias(f"_t_{n}") for n, (k, _) in outs.items()]
    )
    # One row per slice and group touching it: at most slices + groups rows in all.
    at = F.col("_slice").desc() if backward else F.col("_slice")
    w = Window.partitionBy(*group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        "_slice", *group, *[_FOLDS[k](f"_t_{n}").over(w).alias(f"_c_{n}") for n, (k, _) in outs.items()]
    )
    on = reduce(
        lambda a, b: a & b,
        [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in group],
        F.col("r._slice") == F.col("c._slice"),
    )
    joined = inside.alias("r").join(carry.alias("c"), on, "left")

    def total(name, kind):
        a, b = F.col(f"r.{name}"), F.col(f"c._c_{name}")
        if kind == "sum":
            return F.when(a.isNull() & b.isNull(), None).otherwise(
                F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
            )
        return F.greatest(a, b) if kind == "max" else F.least(a, b)

    keep = [F.col(f"r.{c}") for c in rows.columns if c not in outs]
    return joined.select(*keep, *[total(n, k).alias(n) for n, (k, _) in outs.items()])


def ordinal(df: DataFrame, group, order, name, start=0) -> DataFrame:
    """Contiguous position inside the group, counted from `start`, with no single-task window.

    Without a group the rows move once, to be sorted: a row's place in its slice is written with it, and the rows
    of earlier slices come from a summary of one row a slice.
    """
    if not list(group):
        place = F.monotonically_increasing_id()  # the slice in the upper bits, the place in it in the lower 33
        rows = cut(df.orderBy(*order).withColumn("_place", place))
        sliced = rows.withColumn("_slice", F.shiftright("_place", 33))
        w = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carry = sliced.groupBy("_slice").count().select("_slice", F.coalesce(F.sum("count").over(w), F.lit(0)).alias("_before"))
        # As many rows as the sort had partitions.
        joined = sliced.join(F.broadcast(carry), "_slice")
        number = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(start)
        return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != name], number.alias(name))
    out = running(df, group, order, {name: ("sum", F.lit(1).cast("long"))})
    return out.withColumn(name, F.col(name) + F.lit(start - 1))


def dense_ids(keys: DataFrame, order, name, start=0) -> DataFrame:
    """Contiguous ids over the rows of a table of distinct keys."""
    return ordinal(keys, [], order, name, start)


def nearest(rows: DataFrame, marks: DataFrame, group, at, payload, strict=False) -> DataFrame:
    """As-of join in both directions.

    For each row of `rows`, the last mark at or before `at` and the first mark at or after it, inside
    `group` (before and after only, with `strict`). `payload` are mark columns; of several marks at one
    time the smallest payload counts. Adds structs `prev` and `next` with `at` and the payload.
    """
    group = list(group)
    first = marks.filter(F.col(at).isNotNull()).groupBy(*group, at).agg(F.min(F.struct(*payload)).alias("_p"))
    first = first.select(*group, at, F.struct(F.col(at).alias(at), *[F.col(f"_p.{c}").alias(c) for c in payload]).alias("_m"))
    if strict:
        first = running(first, group, [at], {"_b": ("max", F.col("_m"))}, before=True)
    both = rows.withColumn("_is_row", F.lit(1)).unionByName(first.withColumn("_is_row", F.lit(0)), allowMissingColumns=True)
    # One order: a mark stands before the rows of its time. Rows of one time see the same, so they may tie.
    forward, backward = [F.col(at), F.col("_is_row")], [F.col(at).desc(), F.col("_is_row").desc()]
    last = {"prev": ("max", F.when(F.col("_m").isNotNull(), F.struct("_m", "_b")) if strict else F.col("_m"))}
    follow = {"next": ("min", F.col("_m"))}
    limit = limit_of(rows.sparkSession, "windowRows", WINDOW_ROWS)
    if group and oversized(both.select(*group), group, limit) is None:
        near = _running_windows(_running_windows(both, group, forward, last, False), group, backward, follow, False)
    else:
        dealt = slices(both, group, forward)
        near = running_in_slices(running_in_slices(dealt, group, forward, last), group, backward, follow, backward=True).drop("_slice")
    near = near.filter("_is_row = 1")
    if strict:
        near = near.withColumn("prev", F.when(F.col("prev._m")[at] == F.col(at), F.col("prev._b")).otherwise(F.col("prev._m")))
    else:
        near = near.withColumn("next", F.when(F.col("prev")[at] == F.col(at), F.col("prev")).otherwise(F.col("next")))
    return near.drop("_m", "_b", "_is_row")


# --- greedy choices -----------------------------------------------------------------------------


def greedy_pairs(pairs, group, left, right, left_pref, right_pref, fold_order) -> DataFrame:
    """One-to-one greedy choice among candidate pairs, given as (pairs of bounded groups, others or None).

    Walking the pairs in `fold_order`, a pair is taken when both its ends are free. For oversized
    groups the same set is found in rounds: a pair that is the best remaining one for both its ends
    (by `left_pref` and `right_pref`) is final. Both orders must be total, and `fold_order` must agree
    with them in the sense that the first remaining pair is always best for both its ends.
    """
    small, big = pairs
    taken = _greedy_fold(small, group, left, right, fold_order)
    if big is None:
        return taken
    return taken.unionByName(_greedy_rounds(big, left, right, left_pref, right_pref).select(*taken.columns))


def taken_in_order(pairs, left, right, types, give="at") -> Column:
    """The pairs of an array whose both ends, `left` and `right` of an element, are free when they are walked in its
    order: their places, or their left (l) or right (r) ends. `types` are those of the ends."""
    lt, rt = types
    empty = F.struct(
        F.array().cast(f"array<{lt}>").alias("l"),
        F.array().cast(f"array<{rt}>").alias("r"),
        F.array().cast("array<int>").alias("at"),
        F.lit(0).alias("n"),
    )

    def step(acc, p):
        l, r = left(p), right(p)
        used = F.array_contains(acc["l"], l) | F.array_contains(acc["r"], r)
        return F.struct(
            F.when(used, acc["l"]).otherwise(F.array_append(acc["l"], l)).alias("l"),
            F.when(used, acc["r"]).otherwise(F.array_append(acc["r"], r)).alias("r"),
            F.when(used, acc["at"]).otherwise(F.array_append(acc["at"], acc["n"])).alias("at"),
            (acc["n"] + 1).alias("n"),
        )

    return F.aggregate(pairs, empty, step, lambda a: a[give])


def _greedy_fold(pairs, group, left, right, fold_order):
    types = [dict(pairs.dtypes)[c] for c in (left, right)]
    rest = [c for c in pairs.columns if c not in group]
    row = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(fold_order)], F.struct(*rest).alias("row"))
    grouped = pairs.groupBy(*group).agg(F.array_sort(F.collect_list(row)).alias("_ps"))
    chosen = taken_in_order("_ps", lambda p: p["row"][left], lambda p: p["row"][right], types)
    picked = grouped.select(*group, "_ps", F.explode(chosen).alias("_i"))
    picked = picked.select(*group, F.get("_ps", F.col("_i"))["row"].alias("row"))
    return picked.select(*group, *[F.col(f"row.{c}").alias(c) for c in rest]).select(*pairs.columns)


def _first_by(order, name):
    keys = [F.col(c).alias(f"k{i}") for i, c in enumerate(order)]
    return F.min(F.struct(*keys, F.col(name).alias("pick")))["pick"].alias(name)


def _greedy_rounds(pairs, left, right, left_pref, right_pref):
    live, out = cut(pairs), []
    while not live.isEmpty():
        best_l = live.groupBy(left).agg(_first_by(left_pref, right))
        best_r = live.groupBy(right).agg(_first_by(right_pref, left))
        new = cut(live.join(best_l, [left, right], "left_semi").join(best_r, [left, right], "left_semi"))
        out.append(new)
        live = cut(live.join(new.select(left), left, "left_anti").join(new.select(right), right, "left_anti"))
    return union_all(out) if out else live


# --- overlap candidates -------------------------------------------------------------------------


def grid_cells(boxes: DataFrame, up: int) -> DataFrame:
    """Rows repeated once per grid cell in which a partner up to `up` size levels away may be found.

    The cell size follows the box: level L covers boxes up to 2^L long, so a box touches at most four
    cells of its own level and fewer above it. Adds `_lv` (own level), `_gl`, `_gx`, `_gy`.
    """
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    own = boxes.filter((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))).withColumn(
        "_lv", F.ceil(F.log2(side)).cast("int")
    )
    lev = own.withColumn("_gl", F.explode(F.sequence(F.col("_lv"), F.col("_lv") + up)))
    size = F.pow(F.lit(2.0), F.col("_gl"))

    def span(a, b):
        return F.sequence(F.floor(F.col(a) / size).cast("long"), F.floor(F.col(b) / size).cast("long"))

    return lev.withColumn("_gx", F.explode(span("x1", "x2"))).withColumn("_gy", F.explode(span("y1", "y2")))


def levels_apart(a: DataFrame, b: DataFrame, min_iou: float) -> int:
    """How many size levels can lie between two boxes that overlap by `min_iou`.

    An overlap t bounds the ratio of the long sides by 1/t. Without a bound on the overlap the spread
    of levels present in the data is the answer.
    """
    if min_iou > 0:
        return max(0, math.ceil(math.log2(1.0 / min_iou) - 1e-9))
    side = F.ceil(F.log2(F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))))
    both = a.select("x1", "y1", "x2", "y2").union(b.select("x1", "y1", "x2", "y2"))
    lo, hi = both.filter("x2 > x1 and y2 > y1").agg(F.min(side), F.max(side)).first()
    return 0 if lo is None else int(hi - lo)


def overlap_pairs(a: DataFrame, b: DataFrame, keys, cond: Column, min_iou: float) -> DataFrame:
    """Candidate pairs of oversized groups: join on grid cells instead of on the whole group.

    `a` and `b` are aliased l and r inside `cond`, which must imply an overlap of at least `min_iou`
    (or any overlap, for 0). Each pair is found in exactly one cell: the one of the larger level that
    holds the lower corner of the intersection.
    """
    up = levels_apart(a, b, min_iou)
    ca, cb = grid_cells(a, up).alias("l"), grid_cells(b, up).alias("r")
    size = F.pow(F.lit(2.0), F.col("l._gl"))
    on = reduce(
        lambda x, y: x & y,
        [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, "_gl", "_gx", "_gy"]],
    )
    once = (
        (F.col("l._gl") == F.greatest("l._lv", "r._lv"))
        & (F.floor(F.greatest("l.x1", "r.x1") / size) == F.col("l._gx"))
        & (F.floor(F.greatest("l.y1", "r.y1") / size) == F.col("l._gy"))
    )
    return ca.join(cb, on & once & cond)


# --- sequential state ---------------------------------------------------------------------------


class Summary:
    """How stretches of a fold combine, so that they can be summed up apart from each other.

    element(row) is what a row does to the state, combine(a, b) what a and then b do (associative), and
    apply(state, element) the state afterwards. All are Column lambdas; `type` is the element's type.
    """

    def __init__(self, element, combine, apply, type: str):
        self.element, self.combine, self.apply, self.type = element, combine, apply, type


def fold_in_order(df: DataFrame, group, order, state0, state_type: str, step, emit, emit_type: str, summary: Summary) -> DataFrame:
    """Walk each group in `order`, carrying a small state, and give every row an output.

    step(state, row) -> state and emit(state_after, row) -> value are Column lambdas; `state0` is a
    Column over the row columns, read from the first row of the group. Bounded groups are folded in one array.
    Oversized ones are a prefix scan: stretches of bounded length are summed up, the states between them come
    from a scan of the sums, and each stretch is then folded from its own state. The number of jobs grows with
    the logarithm of the length, to the base of the stretch.
    """
    group = list(group)
    limit = limit_of(df.sparkSession, "foldRows", FOLD_ROWS)
    small, big = split_by_size(df, group, limit)
    after = lambda before, state, row: emit(state, row)
    out = _fold_stretch(small, group, order, _first_state(small, group, order, state0, state_type), state_type, step, after, emit_type)
    if big is None:
        return out
    placed = cut(ordinal(big, group, order, "_place"))
    first = cut(_first_state(placed.filter("_place = 0"), group, ["_place"], state0, state_type))
    got = _fold_scan(placed, group, first, state_type, step, after, emit_type, summary, summary.element, limit)
    return out.unionByName(got.drop("_place"))


def _first_state(df, group, order, state0, state_type):
    first = F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], state0.cast(state_type).alias("s")))["s"]
    return df.groupBy(*group).agg(first.alias("_s0"))


def _fold_scan(placed, group, first, state_type, step, emit, emit_type, summary, element, limit):
    """Fold of rows numbered by `_place` from the states `first` of their groups, in stretches of `limit` rows."""
    if placed.filter(F.col("_place") >= limit).isEmpty():
        return _fold_stretch(placed, group, ["_place"], first, state_type, step, emit, emit_type)
    keys = [*group, "_stretch"]
    rows = placed.withColumn("_stretch", F.floor(F.col("_place") / F.lit(limit)))
    cols = [c for c in placed.columns if c not in group]
    parts = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("_place").alias("o"), F.struct(*cols).alias("row")))).alias("_rs"))
    parts = parts.select(*keys, F.transform("_rs", lambda r: element(r["row"]).cast(summary.type)).alias("_es"))
    total = F.aggregate(F.slice("_es", F.lit(2), F.size("_es")), F.get("_es", F.lit(0)), lambda a, b: summary.combine(a, b).cast(summary.type))
    sums = cut(parts.select(*group, F.col("_stretch").alias("_place"), total.alias("_e")))
    between = _fold_scan(sums, group, first, state_type, lambda s, row: summary.apply(s, row["_e"]), lambda before, state, row: before, state_type,
                         summary, lambda row: row["_e"], limit)
    starts = cut(between.select(*group, F.col("_place").alias("_stretch"), F.col("out").alias("_s0")))
    return _fold_stretch(rows, keys, ["_place"], starts, state_type, step, emit, emit_type).drop("_stretch")


def _fold_stretch(df, group, order, first, state_type, step, emit, emit_type):
    """Groups folded in one array each, from the state `_s0` of their row in `first`."""
    cols = [c for c in df.columns if c not in group]
    row = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.struct(*cols).alias("row"))
    g = df.groupBy(*group).agg(F.array_sort(F.collect_list(row)).alias("_rs")).join(first, group)
    acc0 = F.struct(F.col("_s0").alias("s"), F.array().cast(f"array<{emit_type}>").alias("out"))

    def merge_fn(acc, r):
        s = step(acc["s"], r["row"]).cast(state_type)
        value = emit(acc["s"], s, r["row"]).cast(emit_type)
        return F.struct(s.alias("s"), F.array_append(acc["out"], value).alias("out"))

    folded = g.select(*group, "_rs", F.aggregate("_rs", acc0, merge_fn).alias("_f"))
    rows = folded.select(*group, F.explode(F.arrays_zip(F.col("_rs").alias("a"), F.col("_f.out").alias("b"))).alias("z"))
    return rows.select(*group, *[F.col(f"z.a.row.{c}").alias(c) for c in cols], F.col("z.b").alias("out"))


# --- quantiles ------------------------------------------------------------------------------------


def exact_quantiles(df: DataFrame, group, value, qs) -> DataFrame:
    """Exact quantiles {name: q} per group with linear interpolation.

    Spark's exact percentile keeps the distinct values of a group in one task; in oversized groups the values at
    the wanted ranks are found by counting instead.
    """
    group = list(group)
    df = df.filter(F.col(value).isNotNull())
    small, big = split_by_size(df, group, limit_of(df.sparkSession, "windowRows", WINDOW_ROWS))
    out = small.groupBy(*group).agg(*[F.percentile(value, F.lit(q)).alias(n) for n, q in qs.items()])
    if big is None:
        return out
    n = cut(big.groupBy(*group).agg(F.count("*").alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi")))
    at = lambda q: F.lit(float(q)) * (F.col("_n") - 1)
    wanted = F.array_distinct(F.concat(*[F.array(F.floor(at(q)), F.ceil(at(q))) for q in qs.values()]))
    picks = n.select(*group, "_n", F.explode(wanted).alias("_pos"), "_lo", "_hi", F.lit(0).cast("long").alias("_below"))
    picks = values_at(big.select(*group, value), group, value, picks)

    def interpolated(q):
        low = F.max(F.when(F.col("_pos") == F.floor(at(q)), F.col(value)))
        high = F.max(F.when(F.col("_pos") == F.ceil(at(q)), F.col(value)))
        part = F.max(at(q) - F.floor(at(q)))
        return (low + (high - low) * part).cast("double")

    return out.unionByName(picks.groupBy(*group).agg(*[interpolated(q).alias(n) for n, q in qs.items()]))


BINS = 4096


def values_at(rows: DataFrame, group, value, wanted: DataFrame) -> DataFrame:
    """Values at given ranks by counting passes, without a sort: `wanted` with the column `value`.

    wanted: group, _pos (rank from 0), _lo and _hi (bounds that occur), _below (rows under _lo), and any others. Each
    pass counts the rows of the open interval of a rank in bins and goes on with the bin the rank is in, narrowed to
    values that occur; it ends when both bounds are one value. The first and last value are in different bins, so
    every pass narrows, by about BINS where values are spread.
    """
    group = list(group)
    extra = [c for c in wanted.columns if c not in (*group, "_pos", "_lo", "_hi", "_below")]
    still, done = cut(wanted), []
    while True:
        done.append(still.filter("_lo = _hi").select(*group, *extra, "_pos", F.col("_lo").alias(value)))
        still = still.filter("_lo < _hi")
        if still.isEmpty():
            return union_all(done)
        # A rank is a row here; of a group there are two for each quantile at most.
        inside = rows.join(still, group).filter((F.col(value) >= F.col("_lo")) & (F.col(value) <= F.col("_hi")))
        share = (F.col(value).cast("double") - F.col("_lo")) / (F.col("_hi").cast("double") - F.col("_lo"))
        part = F.when(F.col(value) == F.col("_hi"), BINS - 1).otherwise(F.least(F.floor(share * BINS), F.lit(BINS - 2))).cast("int")
        keys = [*group, *extra, "_pos", "_below"]
        bins = inside.groupBy(*keys, part.alias("_bin")).agg(F.count("*").alias("_c"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
        upto = F.sum("_c").over(Window.partitionBy(*group, "_pos").orderBy("_bin"))
        found = bins.withColumn("_upto", F.col("_below") + upto).filter("_upto > _pos and _upto - _c <= _pos")
        still = cut(found.select(*group, *extra, "_pos", "_lo", "_hi", (F.col("_upto") - F.col("_c")).alias("_below")))
