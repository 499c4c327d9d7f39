"""Small helpers the operators share: row access in Arrow batches, word hashes, written tables."""

from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.operators.scale import cut  # noqa: F401  written tables, shared by the operators

BLOCK_BYTES = 2_000_000  # text bytes a task turns into arrays at a time
ODD = np.uint64(0x9E3779B97F4A7C15)  # base of the rolling hashes; odd, so it has an inverse modulo 2**64
ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def columns(df: DataFrame, **names) -> DataFrame:
    """Only the named columns, under names of our own; others may clash with nothing afterwards."""
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in names.items()])


def raw(column) -> list:
    """UTF-8 bytes of a string column; null is empty."""
    col = column.cast(pa.binary()) if not pa.types.is_binary(column.type) else column
    return [b"" if x is None else x for x in col.to_pylist()]


def strings(column) -> list:
    return [x.decode("utf-8", "replace") for x in raw(column)]


def blocks(batches, text="text", limit=BLOCK_BYTES):
    """Slices of the batches whose texts stay near `limit` bytes (one text at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def word_hashes(words, seed=0) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(seed)), np.uint64, len(words))


def powers(n, base=ODD) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = np.full(max(n, 1), base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def window_hashes(h: np.ndarray, k: int, base=ODD) -> np.ndarray:
    """Rabin-Karp hash, modulo 2**64, of every k consecutive values."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(len(h), base), out=total[1:])
    return mixed((total[k:] - total[:n]) * powers(n, inverse))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all (finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def minimum_of(h: np.ndarray, k: int) -> np.ndarray:
    """Smallest of every k consecutive values, by doubling."""
    out, have = h, 1
    while have * 2 <= k:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (k - have)], out[k - have :]) if k > have else out


HUB_ROWS = 100_000  # rows of one key that may meet in a task


def spread_join(many: DataFrame, few: DataFrame, key: str, hub_rows=HUB_ROWS, rows=None, counts=None) -> DataFrame:
    """Inner join on `key`. A key with over `hub_rows` rows in `many` is dealt into slices, and its rows of `few` go to each.

    rows: an upper bound of the rows of any key, if known; without a hub there is nothing to deal.
    counts: (key, count) of the keys, if known.
    """
    if counts is None:
        if (many.count() if rows is None else rows) <= hub_rows:
            return many.join(few, key)
        counts = many.groupBy(key).count()
    hubs = counts.filter(F.col("count") > hub_rows)
    hubs = cut(hubs.select(key, F.ceil(F.col("count") / hub_rows).cast("int").alias("_slices")))
    if hubs.isEmpty():
        return many.join(few, key)
    # There are at most (rows / hub_rows) hubs.
    slices = F.coalesce("_slices", F.lit(1))
    rest = [c for c in many.columns if c != key]
    dealt = many.join(hubs, key, "left").withColumn("_slice", F.pmod(F.xxhash64(*rest), slices).cast("int")).drop("_slices")
    copied = few.join(hubs, key, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("_slices")
    return dealt.join(copied, [key, "_slice"]).drop("_slice")
