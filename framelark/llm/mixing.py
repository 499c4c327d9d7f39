"""Mixing sources to target weights by Pareto order sampling; DataFrame functions only.

Each source gets a target in words. Within a source every document has an expected number of copies, at
most `most`, in proportion to a weight that rises with the length class of the document (its number of
bits) and scaled so that the expected words are the target. The whole part of that number is allocated for
certain; its fraction p is an inclusion probability. Documents are ranked by random odds divided by
inclusion odds, u / (1 - u) over p / (1 - p), and taken in that order while the fixed size, the words still
missing, is not passed; the document that then fits the gap best closes it.

No source is sorted as a whole: ranks fall into slices, as many as the root of the number of rows; sums of
slices tell the slice where the size is reached, and that slice alone is ordered. So one task orders about
the root of a source's rows, twice.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelark.llm import common
from framelark.operators.scale import ordinal

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # of all words that the mix takes
MOST = 2.0  # copies of a source, and of a document
SLICE_POWER = 0.5  # slices of a source: its number of rows to this power
BROADCAST_ROWS = 200_000  # rows of a summary (under 100 bytes each) that may be broadcast
_WORD = r"[^\x20\x09-\x0D]+"
_RANDOM = 4503599627370496.0  # 2**52


def _small(df: DataFrame) -> DataFrame:
    """The written summary, marked for broadcast if it is small."""
    table = common.cut(df)
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _random(mark):
    """A number in (0, 1) from a hexadecimal hash."""
    return (F.conv(F.substring(mark, 1, 13), 16, 10).cast("double") + 0.5) / _RANDOM


def _sized(id_col, text_col, source_col):
    """Columns doc_id, source, size, mark (hash of the doc_id, or of the text without one), its random number u, version (hash of the text)."""
    text, key = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    size = F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")
    mark = F.md5(F.coalesce(key.cast("string"), F.concat(F.lit("?"), F.coalesce(text, F.lit("")))))
    return {"doc_id": key, "source": F.col(f"`{source_col}`"), "size": size, "mark": mark, "u": _random(mark), "version": F.xxhash64(text)}


def _repeats(sized: DataFrame) -> DataFrame | None:
    """(mark, source) that several rows share, or None."""
    found = common.cut(sized.groupBy("mark", "source").count().filter("count > 1").select(F.col("mark").alias("_mark"), F.col("source").alias("_source")))
    if found.isEmpty():
        return None
    return F.broadcast(found) if found.count() <= BROADCAST_ROWS else found


def _told_apart(rows: DataFrame, repeats: DataFrame | None) -> DataFrame:
    """Rows that share a mark get a random number each: from the second on, of the mark and their place among them."""
    if repeats is None:
        return rows
    same = (F.col("mark") == F.col("_mark")) & F.col("source").eqNullSafe(F.col("_source"))
    some = ordinal(rows.join(repeats, same, "left_semi"), ["mark", "source"], ["size", "version"], "_place")
    u = F.when(F.col("_place") == 0, F.col("u")).otherwise(_random(F.md5(F.concat("mark", F.lit("#"), F.col("_place").cast("string")))))
    return rows.join(repeats, same, "left_anti").unionByName(some.withColumn("u", u).drop("_place"))


def _class(size):
    return F.length(F.bin(size))


def targets(sized: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """(source, source_size, n, target) of rows (source, size), by water filling in closed form.

    A row per source is all that one task sees here.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((place - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", most * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before, after, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy(F.lit(1))
    per = per.withColumn("total", share * F.sum("source_size").over(whole))
    per = per.withColumn("level", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # The first source, by limit per weight, that the level does not lift above its limit sets the level of all.
    level = F.min_by(F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("level")), F.when(F.col("level") <= F.col("most") / F.col("weight"), F.col("most") / F.col("weight"))).over(whole)
    per = per.withColumn("level", level)
    return per.select("source", "source_size", "n", F.least("most", F.coalesce(F.col("weight") * F.col("level"), F.col("most"))).alias("target"))


def _classes(sized: DataFrame, sources: DataFrame, most) -> DataFrame:
    """By source and length class: whole copies for certain, fraction p, and the words to be sampled."""
    per = sized.groupBy("source", _class(F.col("size")).alias("class")).agg(F.sum("size").alias("words")).alias("k")
    s = sources.alias("s")
    per = per.join(s, F.col("k.source").eqNullSafe(F.col("s.source"))).select("k.*", "source_size", "target", "n")
    of = Window.partitionBy("source")
    order = of.orderBy(F.col("class").desc())  # falling weight: these reach `most` first
    held = most * F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("words") * F.col("class")).over(order.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", F.when(rest > 0, (F.col("target") - held) / rest))
    fits = F.col("level") * F.col("class") <= most
    per = per.withColumn("level", F.max_by(F.when(fits, F.col("level")), F.when(fits, F.col("class"))).over(of))
    copies = F.least(F.lit(most), F.coalesce(F.col("level") * F.col("class"), F.lit(most)))
    per = per.withColumn("copies", copies).withColumn("certain", F.floor("copies"))
    per = per.withColumn("p", F.col("copies") - F.col("certain"))
    return per.withColumn("need", F.col("target") - F.sum(F.col("certain") * F.col("words")).over(of))


def _with_rank(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows with the summary of their class and the rank (null where nothing is left to chance)."""
    r, k = rows.withColumn("class", _class(F.col("size"))).alias("r"), classes.alias("k")
    same = F.col("r.source").eqNullSafe(F.col("k.source")) & (F.col("r.class") == F.col("k.class"))
    rank = F.when(F.col("p") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p"))))
    return r.join(k, same).select("r.*", "source_size", "target", "n", "certain", "p", "need").withColumn("rank", rank)


def _cuts(ranked: DataFrame) -> DataFrame:
    """By source: the last (rank, doc_id) taken in order, and the (rank, doc_id) that fills the gap best."""
    open_rows = ranked.filter("rank is not null and size > 0")
    many = F.ceil(F.pow("n", F.lit(SLICE_POWER)))
    open_rows = open_rows.withColumn("slice", F.floor(F.col("rank") / (1 + F.col("rank")) * many))
    slices = open_rows.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("need").alias("need"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0))
    slices = slices.withColumn("upto", upto)
    passed = slices.filter("upto > need").groupBy("source").agg(F.min_by(F.struct("slice", (F.col("upto") - F.col("words")).alias("before")), "slice").alias("c"))
    passed = _small(passed.select(F.col("source").alias("_source"), F.col("c.slice").alias("at"), F.col("c.before").alias("before")))
    inside = open_rows.join(passed, F.col("source").eqNullSafe(F.col("_source")))
    crossing = inside.filter("slice = at")
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "size")
    crossing = crossing.withColumn("upto", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    taken = F.when(F.col("upto") <= F.col("need"), F.struct("rank", "doc_id"))
    cut = crossing.groupBy("source").agg(F.max(taken).alias("last"), (F.first("need") - F.coalesce(F.max(F.when(F.col("upto") <= F.col("need"), F.col("upto"))), F.first("before"))).alias("gap"), F.first("at").alias("at"))
    cut = _small(cut.select(F.col("source").alias("_source"), "last", "gap", "at"))
    later = open_rows.join(cut, F.col("source").eqNullSafe(F.col("_source")))
    later = later.filter((F.col("slice") > F.col("at")) | (F.col("slice") == F.col("at")) & (F.col("last").isNull() | (F.struct("rank", "doc_id") > F.col("last"))))
    fill = later.groupBy("source").agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), "rank", "doc_id", "gap")).alias("f"))
    fill = fill.select(F.col("source").alias("_s"), F.when(F.col("f.off") < F.col("f.gap"), F.struct("f.rank", "f.doc_id")).alias("fill"))
    out = cut.join(fill, F.col("_source").eqNullSafe(F.col("_s")), "left")
    return out.select(F.col("_source").alias("cut_source"), "at", "last", "fill")


class Mix:
    """The summaries that decide for every row how many copies the mix takes of it."""

    def __init__(self, docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, most=MOST):
        self.names = (id_col, text_col, source_col)
        sized = common.cut(docs.select(*[c.alias(n) for n, c in _sized(*self.names).items()]))
        self.repeats = _repeats(sized)
        self.sized = sized if self.repeats is None else common.cut(_told_apart(sized, self.repeats))
        sources = _small(targets(self.sized, weights, share, most))
        self.classes = _small(_classes(self.sized, sources, most))
        self.cuts = _small(_cuts(_with_rank(self.sized, self.classes)))

    def decide(self, rows: DataFrame) -> DataFrame:
        """Rows (doc_id, source, size, u, ...) with source_size, target and copies."""
        ranked = _with_rank(rows, self.classes)
        out = ranked.join(self.cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        many = F.ceil(F.pow("n", F.lit(SLICE_POWER)))
        slice_of = F.floor(F.col("rank") / (1 + F.col("rank")) * many)
        here = F.struct("rank", "doc_id")
        in_order = (slice_of < F.col("at")) | (slice_of == F.col("at")) & (here <= F.col("last"))
        sampled = F.col("rank").isNotNull() & (F.col("cut_source").isNull() | F.coalesce(in_order, F.lit(False)) | F.coalesce(here == F.col("fill"), F.lit(False)))
        return out.withColumn("copies", (F.col("certain") + sampled.cast("int")).cast("bigint"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target, taken, source, copies.

    A null text has size 0, a null source is a source of its own, ordered last. The random number of a row comes
    from its doc_id, or its text without one; rows of a source that repeat one are told apart by their place
    among them, by size and text, so a source of nothing but copies meets its target too. An empty table gives an
    empty one.
    """
    mix = Mix(docs, **options)
    out = mix.decide(mix.sized)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, columns as they are, each as often as the mix takes it."""
    mix = Mix(docs, **options)
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in _sized(*mix.names).items()])
    taken = mix.decide(_told_apart(rows, mix.repeats)).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


ORACLE = r"""
WITH marked AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '?' || coalesce(text, ''))) AS mark
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY mark, source ORDER BY size) - 1 AS place FROM marked),
sized AS (
  SELECT doc_id, source, size, (('0x' || substr(CASE WHEN place = 0 THEN mark ELSE md5(mark || '#' || place) END, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM placed),
per AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
lift AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS reach,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source IS NULL, source)),
target AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size,
         coalesce(weight * (SELECT arg_min(level, reach) FROM lift WHERE level <= reach), 2.0::DOUBLE * source_size)) AS target
  FROM lift),
kinds AS (
  SELECT s.source, length(bin(s.size)) AS class, sum(s.size)::DOUBLE AS words, any_value(t.source_size) AS source_size, any_value(t.target) AS target
  FROM sized s JOIN target t ON s.source IS NOT DISTINCT FROM t.source GROUP BY s.source, length(bin(s.size))),
held AS (
  SELECT *, (target - 2.0::DOUBLE * coalesce(sum(words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / nullif(sum(words * class) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS level
  FROM kinds WINDOW w AS (PARTITION BY source ORDER BY class DESC)),
copied AS (
  SELECT k.*, least(2.0::DOUBLE, coalesce((SELECT arg_max(h.level, h.class) FROM held h WHERE h.source IS NOT DISTINCT FROM k.source AND h.level * h.class <= 2.0::DOUBLE) * k.class, 2.0::DOUBLE)) AS copies
  FROM kinds k),
wanted AS (
  SELECT *, floor(copies) AS certain, copies - floor(copies) AS p, target - sum(floor(copies) * words) OVER (PARTITION BY source) AS need FROM copied),
ranked AS (
  SELECT s.*, w.source_size, w.target, w.certain, w.need, CASE WHEN w.p > 0 THEN (s.u / (1 - s.u)) / (w.p / (1 - w.p)) END AS rank
  FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source AND length(bin(s.size)) = w.class),
ordered AS (
  SELECT *, sum(CASE WHEN rank IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM ranked),
gaps AS (
  SELECT source, any_value(need) - coalesce(max(upto) FILTER (WHERE upto <= need), 0) AS gap FROM ordered WHERE rank IS NOT NULL GROUP BY source),
fills AS (
  SELECT o.source, o.doc_id, o.size, o.rank, row_number() OVER (PARTITION BY o.source ORDER BY abs(g.gap - o.size), o.rank, o.doc_id) AS place, abs(g.gap - o.size) < g.gap AS fits
  FROM ordered o JOIN gaps g ON o.source IS NOT DISTINCT FROM g.source WHERE o.rank IS NOT NULL AND o.upto > o.need AND o.size > 0)
SELECT o.doc_id, o.size, o.source_size::BIGINT AS source_size, o.target,
       (o.size * (o.certain + CASE WHEN o.rank IS NOT NULL AND (o.upto <= o.need OR f.rank IS NOT NULL) THEN 1 ELSE 0 END))::BIGINT AS taken,
       o.source, (o.certain + CASE WHEN o.rank IS NOT NULL AND (o.upto <= o.need OR f.rank IS NOT NULL) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM ordered o LEFT JOIN fills f ON f.place = 1 AND f.fits AND o.source IS NOT DISTINCT FROM f.source AND o.rank = f.rank AND o.doc_id IS NOT DISTINCT FROM f.doc_id
"""
