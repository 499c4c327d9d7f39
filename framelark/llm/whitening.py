"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Entries become integers on a grid, so the scatter n * sum(x x') - (sum x)(sum x)' of the distinct vectors is an
integer matrix, summed by tasks without rounding. Its characteristic polynomial is found modulo many primes,
each by Hessenberg reduction in a task of its own, and put together by Chinese remainders. As all its roots are
real, the signs of the shifted coefficients count the roots above a point, so bisection isolates each to any
number of digits. Components are null vectors of scatter - root, by inverse iteration in as many digits.

What the driver holds is bounded by the dimension: the scatter, the coefficients and the components.
"""

import math
import random
from collections import Counter
from decimal import Context, Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelark.llm import common

GRID = 256  # steps of the grid to a unit
COMPONENTS = 4
ROOT_BITS = 200  # binary digits of a root below its leading one
DIGITS = 90  # decimal digits of the inverse iteration
_LOW = 60  # sums of products travel as high and low part, split here


def on_grid(df: DataFrame, id_col="vec_id", vector_col="embedding", grid=GRID) -> DataFrame:
    """(vec_id, x): entries as steps of the grid, without rows that are null or have null or non-finite entries.

    Vectors whose length is not the most frequent one (of equally frequent ones the longest) have no place in
    the same space and are left out as well, as are empty vectors.
    """
    rows = common.columns(df, vec_id=id_col, c=vector_col)
    finite = F.forall("c", lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    rows = rows.filter(F.col("c").isNotNull() & (F.size("c") > 0) & finite)
    rows = rows.select("vec_id", F.transform("c", lambda c: F.floor(c.cast("double") * grid)).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).count().groupBy().agg(F.max(F.struct("count", "d")).alias("m")).first()["m"]
    return rows.filter(F.size("x") == F.lit(lengths["d"] if lengths else 0))


def _matrix(batch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _exact_products(x: np.ndarray) -> np.ndarray:
    """x' x of int64 entries as Python integers: limbs small enough for exact sums in doubles."""
    width = max(1, (53 - max(1, len(x)).bit_length()) // 2)
    limbs, rest, signs = [], np.abs(x.astype(object)) if x.size and x.min() == np.iinfo(np.int64).min else np.abs(x), np.sign(x)
    while rest.any():
        limbs.append(((rest & ((1 << width) - 1)) * signs).astype(np.float64))
        rest = rest >> width
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += (a.T @ b).astype(np.int64).astype(object) << (width * (i + j))
    return total


def scatter_sums(fit: DataFrame, d: int):
    """(n, sums, products) over the rows of column x, in Python integers."""
    upper = np.triu_indices(d + 1)

    def partial(batches):
        total = np.zeros((d + 1, d + 1), object)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                x = _matrix(batch.slice(at, 8192))
                total += _exact_products(np.column_stack([np.ones(len(x), np.int64), x]))
        values = total[upper].tolist()
        high = [Decimal(v >> _LOW) for v in values]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(high, pa.decimal128(38, 0)), pa.array([v & ((1 << _LOW) - 1) for v in values], pa.int64())], ["at", "high", "low"])

    parts = fit.select("x").mapInArrow(partial, "at int, high decimal(38,0), low long")
    found = parts.groupBy("at").agg(F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    total = np.zeros((d + 1, d + 1), object)
    for r in found:
        i, j = upper[0][r["at"]], upper[1][r["at"]]
        total[i, j] = total[j, i] = (int(r["high"]) << _LOW) + int(r["low"])
    return total[0, 0], total[0, 1:], total[1:, 1:]


# --- characteristic polynomial ----------------------------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller and Rabin's test with the bases that decide all numbers below 3.3e24."""
    small = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41)
    if n < 2 or any(n % p == 0 for p in small):
        return n in small
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in small:
        y = pow(a, odd, n)
        if y in (1, n - 1):
            continue
        for _ in range(twos - 1):
            y = y * y % n
            if y == n - 1:
                break
        else:
            return False
    return True


def primes_for(bits: int) -> list:
    """The largest primes under 2**31 whose product has more than `bits` bits."""
    out, held, n = [], 0.0, (1 << 31) - 1
    while held <= bits:
        if is_prime(n):
            out.append(n)
            held += math.log2(n)
        n -= 2
    return out


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to a modulo p with zeros below the first subdiagonal."""
    a, d = a.copy(), len(a)
    for k in range(1, d - 1):
        below = np.flatnonzero(a[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            a[:, [k, pivot]] = a[:, [pivot, k]]
        f = a[k + 1 :, k - 1] * pow(int(a[k, k - 1]), -1, p) % p
        a[k + 1 :] = (a[k + 1 :] - f[:, None] * a[k] % p) % p
        a[:, k] = (a[:, k] + (a[:, k + 1 :] * f % p).sum(1)) % p
    return a


def polynomial_modulo(matrix, p: int) -> list:
    """Coefficients, lowest first, of det(t - matrix) modulo the prime p < 2**31."""
    h = hessenberg(np.array([[int(v) % p for v in row] for row in matrix], np.int64), p)
    d = len(h)
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(d):
        new = np.zeros(d + 1, np.int64)
        new[1:] = polys[k, :-1]
        scale, factors = 1, [int(h[k, k])]
        for i in range(k - 1, -1, -1):
            scale = scale * int(h[i + 1, i]) % p
            factors.append(int(h[i, k]) * scale % p)
        terms = np.array(factors[::-1], np.int64)[:, None] * polys[: k + 1] % p
        polys[k + 1] = (new - terms.sum(0)) % p
    return polys[d].tolist()


def characteristic_polynomial(spark, matrix) -> list:
    """Coefficients, lowest first, of det(t - matrix) of a symmetric integer matrix without negative roots.

    By Maclaurin's inequality a coefficient is below (1 + trace / d) ** d, which bounds the number of primes.
    """
    d = len(matrix)
    bits = d * math.log2(1 + int(sum(matrix[i][i] for i in range(d))) // d + 1) + 2
    primes = primes_for(math.ceil(bits))
    rows = [[int(v) for v in row] for row in matrix]

    def reduce(batches):
        for batch in batches:
            ps = batch.column("p").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array([polynomial_modulo(rows, p) for p in ps], pa.list_(pa.int64()))], ["p", "c"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    todo = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    residues = todo.mapInArrow(reduce, "p long, c array<long>").collect()
    whole = math.prod(primes)
    shares = {p: whole // p * pow(whole // p, -1, p) for p in primes}
    out = [sum(shares[r["p"]] * r["c"][i] for r in residues) % whole for i in range(d + 1)]
    return [c - whole if c > whole // 2 else c for c in out]


# --- roots --------------------------------------------------------------------------------------------


def roots_above(poly: list, t: int) -> int:
    """How many roots of a polynomial with only real roots lie above t: sign changes after the shift by t."""
    c = poly[::-1]
    for stop in range(len(c), 1, -1):
        for i in range(1, stop):
            c[i] += t * c[i - 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(poly, t):
    out = 0
    for c in reversed(poly):
        out = out * t + c
    return out


def largest_roots(poly: list, k: int, bits=ROOT_BITS) -> list:
    """The k largest roots, with repeats, as (numerator, scale): root = numerator / 2**scale, off by less than one step."""
    d, top, out = len(poly) - 1, 1, []
    while roots_above(poly, top):
        top *= 2
    while len(out) < min(k, d):
        rank = len(out) + 1
        low, high, scale, scaled = -1, top, 0, poly  # the root of this rank is in (low, high]
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if roots_above(poly, mid) >= rank else (low, mid)
        wanted = max(0, bits - high.bit_length())
        while scale < wanted:
            # One root alone in the interval changes the sign there; several are told apart by counting.
            above, upto = roots_above(scaled, high), roots_above(scaled, low)
            if upto - above == 1 and _value(scaled, high):
                scaled, low, high = [c << ((d - i) * (wanted - scale)) for i, c in enumerate(scaled)], low << (wanted - scale), high << (wanted - scale)
                scale, positive = wanted, _value(scaled, high) > 0
                while high - low > 1:
                    mid = (low + high) // 2
                    low, high = (low, mid) if (_value(scaled, mid) > 0) == positive or not _value(scaled, mid) else (mid, high)
                break
            step = min(8, wanted - scale)
            scaled, low, high, scale = [c << ((d - i) * step) for i, c in enumerate(scaled)], low << step, high << step, scale + step
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if roots_above(scaled, mid) >= rank else (low, mid)
        same = roots_above(scaled, low) - len(out)  # roots no digit of the wanted ones tells apart
        out += [(high, scale)] * max(1, same)
    return out[:k]


# --- components -----------------------------------------------------------------------------------------


def _solver(matrix, root):
    """Solves (matrix - root) y = b by elimination with row exchanges; a pivot of zero counts as a tiny one."""
    d = len(matrix)
    a = np.array([[Decimal(int(v)) for v in row] for row in matrix], object)
    a[np.arange(d), np.arange(d)] -= root
    tiny = max(abs(v) for v in a.ravel()) * Decimal(10) ** (5 - DIGITS) or Decimal(10) ** -DIGITS
    order = list(range(d))
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(a[i, k]))
        a[[k, best]] = a[[best, k]]
        order[k], order[best] = order[best], order[k]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        if k + 1 < d:
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= a[k + 1 :, k][:, None] * a[k, k + 1 :]

    def solve(b):
        y = b[order].copy()
        for k in range(1, d):
            y[k] -= (a[k, :k] * y[:k]).sum()
        for k in range(d - 1, -1, -1):
            y[k] = (y[k] - ((a[k, k + 1 :] * y[k + 1 :]).sum() if k + 1 < d else 0)) / a[k, k]
        return y

    return solve


def null_vectors(matrix, root, count: int, rounds=3) -> list:
    """`count` orthonormal vectors that matrix - root sends to zero, as Decimals."""
    solve, rng, d = _solver(matrix, root), random.Random(1), len(matrix)
    vectors = [np.array([Decimal(rng.randint(-(10**6), 10**6)) for _ in range(d)], object) for _ in range(count)]
    for _ in range(rounds):
        basis = []
        for v in vectors:
            y = solve(v / max(abs(c) for c in v))
            y = y / max(abs(c) for c in y)
            for _ in range(2):
                for b in basis:
                    y = y - (b * y).sum() * b
            basis.append(y / (y * y).sum().sqrt())
        vectors = basis
    return vectors


class Whitening:
    """n, sums, and the components: unit vectors, eigenvalues of the covariance, and shares of the trace."""

    def __init__(self, n, sums, vectors, values, explained):
        self.n, self.sums, self.vectors, self.values, self.explained = n, sums, vectors, values, explained

    def project(self, x: np.ndarray) -> np.ndarray:
        """x - mean on each component over the component's deviation."""
        exact = max(1, int(self.n)) * (int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) + max(abs(int(s)) for s in self.sums) < 1 << 53
        offset = x * int(self.n) - np.array([int(s) for s in self.sums], np.int64) if exact else x.astype(object) * int(self.n) - self.sums
        return (offset / int(self.n)).astype(np.float64) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list:
        """Sum over the dimensions of (n * x - sum)**2, in integers."""
        bound = int(self.n) * (int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) + max(abs(int(s)) for s in self.sums)
        if bound * bound * x.shape[1] < 1 << 63:
            return ((x * int(self.n) - np.array([int(s) for s in self.sums], np.int64)) ** 2).sum(1).tolist()
        return ((x.astype(object) * int(self.n) - self.sums) ** 2).sum(1).tolist()


def fit_whitening(distinct: DataFrame, components=COMPONENTS) -> Whitening | None:
    """Fitted on the distinct vectors of column x; None where they do not vary.

    Roots that agree in all digits sought share a space, from which any orthonormal vectors are taken.
    Components without variance are left out.
    """
    first = distinct.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    n, sums, products = scatter_sums(distinct, first["d"])
    matrix = products * n - np.outer(sums, sums)
    trace = int(np.trace(matrix))
    if not trace:
        return None
    roots = largest_roots(characteristic_polynomial(distinct.sparkSession, matrix.tolist()), components)
    with localcontext(Context(prec=DIGITS)):
        # Zero variance shows as a root below one: the roots of an integer polynomial have no smaller product.
        found = [(Decimal(a) / Decimal(1 << s), c) for (a, s), c in Counter(roots).items()]
        floor = Decimal(trace) * Decimal(2) ** (-ROOT_BITS // 2)
        found = [(root, c) for root, c in found if root > floor]
        vectors = [v for root, c in found for v in null_vectors(matrix, root, c)]
        values = [float(root / (n * n)) for root, c in found for _ in range(c)]
        explained = [float(root / trace) for root, c in found for _ in range(c)]
    return Whitening(n, sums, np.array(vectors, np.float64).T, np.array(values), explained)


def whiten(df: DataFrame, id_col="vec_id", vector_col="embedding", components=COMPONENTS, grid=GRID) -> DataFrame:
    """Rows of `df` that can be whitened, one row each: vec_id, n, deviation, whitened (array), explained (array), identity_error.

    Null vectors and those with null or non-finite entries are dropped, as in `on_grid`. The fit takes each
    distinct vector once, whatever its number of copies. Fewer components are returned where fewer have any
    variance; where none has (no row, or all vectors equal) the result is empty. A deviation beyond 38 digits
    is null. Entries beyond the range of a long count as its ends.
    """
    rows = on_grid(df, id_col, vector_col, grid)
    distinct = common.cut(rows.select("x").distinct())
    fitted = fit_whitening(distinct, components)
    schema = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    schema = schema.replace("vec_id long", f"vec_id {rows.schema['vec_id'].dataType.simpleString()}")
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    k = len(fitted.values)

    def projected(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in fitted.project(_matrix(batch)).T], [f"w{i}" for i in range(k)])

    white = distinct.mapInArrow(projected, ", ".join(f"w{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = white.agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)

    def output(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = _matrix(batch), batch.num_rows
            deviation = [Decimal(v) if v < 10**38 else None for v in fitted.deviations(x)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([int(fitted.n)] * m, pa.int64()), pa.array(deviation, pa.decimal128(38, 0)),
                 pa.array(list(fitted.project(x)), pa.list_(pa.float64())), pa.array([fitted.explained] * m, pa.list_(pa.float64())), pa.array([error] * m)],
                ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(output, schema)


def report(df: DataFrame, **options) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation (null beyond a long), whitened, explained, identity_error."""
    out = whiten(df, **options)
    each = out.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "z"))
    fits = F.when(F.col("deviation") < F.lit("9223372036854775808").cast("decimal(38,0)"), F.col("deviation")).cast("bigint")
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", fits.alias("deviation"), "z.whitened", "z.explained", "identity_error")
