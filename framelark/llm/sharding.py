"""Shards of bounded bytes by extendible hashing; DataFrame functions only.

A document hashes to BITS bits. Starting from one bucket, a bucket over the limit splits on the next bit,
and only such buckets do; the directory maps every prefix of the global depth to a bucket. Bucket sizes
come from counts of hash prefixes, aggregated before they are shuffled; the documents themselves meet the
list of buckets, never each other.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm import common
from framelark.operators.scale import running

BITS = 52
STEP = 4  # bits by which counts of oversized prefixes are refined
SHARD_BYTES = 128 << 20
BROADCAST_ROWS = 200_000  # buckets (under 100 bytes each) that may be broadcast


def _hashed(id_col, text_col):
    """Columns: bytes of the text, hash of the doc_id, or of the text where there is none."""
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    name = F.coalesce(key.cast("string"), F.concat(F.lit("?"), F.coalesce(text, F.lit(""))))
    return {"doc_id": key, "bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"),
            "h": F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("bigint")}


def _prefix(depth):
    return F.shiftright("h", BITS - depth)


def _levels(rows: DataFrame, low: int, high: int) -> DataFrame:
    """(depth, prefix, bytes) for depths low..high; the finest is aggregated first, the rest from it."""
    fine = rows.groupBy(_prefix(high).alias("prefix")).agg(F.sum("bytes").alias("bytes"))
    up = F.explode(F.sequence(F.lit(0), F.lit(high - low))).alias("up")
    return fine.select("prefix", "bytes", up).groupBy((F.lit(high) - F.col("up")).alias("depth"), F.expr("shiftright(prefix, up)").alias("prefix")).agg(F.sum("bytes").alias("bytes"))


def _broadcast(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def directory(sized: DataFrame, limit: int, bits=BITS) -> DataFrame:
    """Buckets (depth, prefix, bucket_bytes) of rows (bytes, h): the shallowest prefixes within the limit.

    A prefix of `bits` bits does not split further, whatever its size.
    """
    total = sized.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    depth = min(bits, max(1, math.ceil(math.log2(max(total / limit, 1))) + 3))
    levels, rows, low = [], sized, 0
    while True:
        levels.append(common.cut(_levels(rows, low, depth)))
        over = levels[-1].filter((F.col("depth") == depth) & (F.col("bytes") > limit)).select("prefix")
        if depth == bits or over.isEmpty():
            break
        rows = rows.join(_broadcast(common.cut(over)), _prefix(depth) == F.col("prefix"), "left_semi")
        low, depth = depth + 1, min(bits, depth + STEP)
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    above = every.select((F.col("depth") + 1).alias("_depth"), F.col("prefix").alias("_prefix"), F.col("bytes").alias("_bytes"))
    own = every.join(above, (F.col("depth") == F.col("_depth")) & (F.shiftright("prefix", 1) == F.col("_prefix")), "left")
    leaf = ((F.col("bytes") <= limit) | (F.col("depth") == bits)) & (F.col("_bytes").isNull() | (F.col("_bytes") > limit))
    return own.filter(leaf).select("depth", "prefix", F.col("bytes").alias("bucket_bytes"))


def shards(docs: DataFrame, limit=SHARD_BYTES, id_col="doc_id", text_col="text", bits=BITS) -> DataFrame:
    """One row per row of `docs`: doc_id, bytes, shard, depth, shard_bytes.

    shard: the bits of the bucket's prefix. Rows that share all bits (rows that repeat a doc_id, or a text
    where there is none) are cut by running bytes once their bucket is over the limit, and the shard then
    ends in -0, -1 and so on. A document larger than the limit stands in a shard of its own. Null and empty
    texts have no bytes; an empty table gives an empty one.
    """
    sized = common.cut(docs.select(*[c.alias(n) for n, c in _hashed(id_col, text_col).items()]))
    buckets = common.cut(directory(sized, limit, bits))
    depths = sorted(r.depth for r in buckets.select("depth").distinct().collect())  # at most one per bit
    if not depths:
        return sized.select("doc_id", "bytes", F.lit("").alias("shard"), F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("shard_bytes"))
    keys = F.array(*[F.struct(F.lit(d).alias("_depth"), _prefix(d).alias("_prefix")) for d in depths])
    rows = sized.select("*", F.explode(keys).alias("k")).select("doc_id", "bytes", "h", "k.*")
    found = rows.join(_broadcast(buckets), (F.col("_depth") == F.col("depth")) & (F.col("_prefix") == F.col("prefix")))
    name = F.when(F.col("depth") > 0, F.expr("lpad(bin(prefix), depth, '0')")).otherwise("")
    found = found.select("doc_id", "bytes", "h", name.alias("shard"), "depth", F.col("bucket_bytes").alias("shard_bytes"))
    if buckets.filter(F.col("bucket_bytes") > limit).isEmpty():
        return found.drop("h")
    small, large = found.filter(F.col("shard_bytes") <= limit), found.filter(F.col("shard_bytes") > limit)
    return small.drop("h").unionByName(_cut_up(large, limit))


def _cut_up(rows: DataFrame, limit: int) -> DataFrame:
    """Buckets of rows whose hashes agree, cut into pieces by running bytes.

    Pieces begin every limit / 2 bytes, so one holds less than the limit unless a row alone is over half of
    it; such rows get a piece each.
    """
    half = max(1, limit // 2)
    numbered = common.cut(rows.withColumn("_row", F.monotonically_increasing_id()))
    small = numbered.filter(F.col("bytes") <= half)
    small = running(small, ["shard"], ["_row"], {"upto": ("sum", F.col("bytes"))}, before=True)
    small = small.withColumn("piece", F.concat(F.lit("-"), F.floor(F.coalesce("upto", F.lit(0)) / half).cast("string"))).drop("upto")
    large = numbered.filter(F.col("bytes") > half)
    large = large.withColumn("piece", F.concat(F.lit("-r"), F.col("_row").cast("string")))
    both = small.unionByName(large).withColumn("shard", F.concat("shard", "piece"))
    sums = both.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"))
    return both.drop("shard_bytes").join(sums, "shard").select("doc_id", "bytes", "shard", "depth", "shard_bytes")


def oracle(limit: int, most: int = 24) -> str:
    """The same rows in SQL, for data whose buckets fit at `most` bits."""
    return f"""
WITH sized AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '?' || coalesce(text, ''))), 1, 13))::BIGINT AS h FROM documents),
levels AS (
  SELECT d::INT AS depth, h >> ({BITS} - d::INT) AS prefix, sum(bytes)::BIGINT AS bytes
  FROM sized, range(0, {most} + 1) t(d) GROUP BY ALL),
leaves AS (
  SELECT a.* FROM levels a LEFT JOIN levels b ON b.depth = a.depth - 1 AND b.prefix = a.prefix >> 1
  WHERE a.bytes <= {limit} AND (b.bytes IS NULL OR b.bytes > {limit}))
SELECT s.doc_id, s.bytes, CASE WHEN l.depth = 0 THEN '' ELSE lpad(bin(l.prefix), l.depth, '0') END AS shard, l.depth, l.bytes AS shard_bytes
FROM sized s JOIN leaves l ON l.prefix = s.h >> ({BITS} - l.depth)
"""
