"""Whitening of embeddings on exact eigenvalues.

Vectors are integers, so their scatter matrix is too. Its characteristic polynomial is found exactly: modulo many
primes, each in a task of its own, by reduction to Hessenberg form, and put together by remainders. All its
roots are real, so the signs of a shifted polynomial count the roots above a point; bisection isolates and refines
them to FRACTION bits. A component is the null space of the matrix less a root, by inverse iteration in integers.

What reaches the driver depends on the dimension only: sums and products of components, remainders, components.
"""

import math

from pyspark.sql import functions as F

FRACTION = 160  # Bits behind the point of roots and components.
LARGEST = 1 << 38  # Components from here on cannot be scaled exactly and count as non-finite.
SLICE = 4096  # Rows that are multiplied at a time.


def finite_vectors(table, id_column="vec_id", vector_column="embedding"):
    """vec_id and vector (array of double) of the rows whose vector has only finite components."""
    rows = table.select(table[id_column].cast("long").alias("vec_id"), table[vector_column].cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    return rows.filter(F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.size("vector") > 0))


def integer_batches(batches, scale):
    """ids and floor(scale * component) of Arrow batches of vectors of equal length, in slices."""
    import numpy as np
    for batch in batches:
        if batch.num_rows:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            matrix = np.floor(flat * scale).astype("int64").reshape(batch.num_rows, -1)
            for at in range(0, len(matrix), SLICE):
                yield batch.column(0).slice(at, SLICE), matrix[at:at + SLICE]


def exact_product(a):
    """a.T @ a in integers: by floating point where every sum stays below 2**53, else by Python's integers."""
    import numpy as np
    if int(np.abs(a).max()) ** 2 * len(a) < 1 << 53:
        real = a.astype("float64")
        return (real.T @ real).astype("int64").astype(object)
    wide = a.astype(object)
    return wide.T @ wide


def summed(rows, of_task, kind):
    """Add up, place by place, the lists that ``of_task`` makes of each task's batches; as a list."""
    def run(batches):
        import pyarrow as pa
        values = of_task(batches)
        if values is not None:
            places = pa.array(range(len(values)), pa.int32())
            yield pa.RecordBatch.from_arrays([places, pa.array(values, pa.decimal128(38, 0) if kind != "double" else pa.float64())], ["place", "value"])
    parts = rows.mapInArrow(run, f"place int, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    return [r.value for r in sorted(parts.collect())]


def scatter(rows, dimension, scale):
    """n, the sums of the integer components, and n * (products) - (sums) * (sums): n * n times their covariance."""
    import numpy as np
    upper = np.triu_indices(dimension)

    def of_task(batches):
        from decimal import Decimal
        n, sums, products = 0, None, None
        for _, matrix in integer_batches(batches, scale):
            part = exact_product(matrix)
            n, sums, products = n + len(matrix), matrix.sum(axis=0).astype(object) + (0 if sums is None else sums), part + (0 if products is None else products)
        return None if not n else [Decimal(int(v)) for v in (n, *sums, *products[upper])]

    total = [int(v) for v in summed(rows, of_task, "decimal(38,0)")]
    n, sums = total[0], np.array(total[1:dimension + 1], object)
    products = np.zeros((dimension, dimension), object)
    products[upper] = total[dimension + 1:]
    products.T[upper] = products[upper]
    return n, sums, n * products - np.outer(sums, sums)


def is_prime(n):
    """Miller's test; these bases decide for all n below 2**32."""
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if x in (1, n - 1) or base % n == 0:
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def characteristic_modulo(matrix, p):
    """Coefficients of det(x - matrix) modulo a prime below 2**31, from the constant on."""
    import numpy as np
    h = (matrix % p).astype("int64")
    d = len(h)
    for k in range(1, d - 1):  # Similar matrices, until all is 0 below the first subdiagonal.
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        h[[k, pivot]] = h[[pivot, k]]
        h[:, [k, pivot]] = h[:, [pivot, k]]
        factors = h[k + 1:, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1:] = (h[k + 1:] - factors[:, None] * h[k]) % p
        h[:, k] = (h[:, k] + (h[:, k + 1:] * factors % p).sum(axis=1)) % p
    polynomials = np.zeros((d + 1, d + 1), "int64")
    polynomials[0, 0] = 1
    for m in range(1, d + 1):
        current = np.zeros(d + 1, "int64")
        current[1:] = polynomials[m - 1, :-1]
        chain = 1
        for i in range(m):  # The last column, with the product of the subdiagonal on the way.
            factor = chain * int(h[m - 1 - i, m - 1]) % p
            current = (current - factor * polynomials[m - 1 - i]) % p
            if i < m - 1:
                chain = chain * int(h[m - 1 - i, m - 2 - i]) % p
        polynomials[m] = current
    return polynomials[d].tolist()


def characteristic_polynomial(spark, matrix):
    """Exact coefficients of det(x - matrix) of a positive semidefinite integer matrix, from the constant on.

    The k-th symmetric function of the roots is at most binomial(d, k) * (trace / d) ** k, so primes are taken until
    their product is larger than any of them.
    """
    d, trace = len(matrix), int(matrix.trace())
    bound = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    primes, product, candidate = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(candidate):
            primes.append(candidate)
            product *= candidate
        candidate -= 2

    def remainders(frames):
        import pandas as pd
        for frame in frames:
            yield pd.DataFrame({"i": frame["id"], "remainders": [characteristic_modulo(matrix, primes[i]) for i in frame["id"]]})

    found = spark.range(0, len(primes), 1, min(len(primes), spark.sparkContext.defaultParallelism)).mapInPandas(remainders, "i long, remainders array<long>")
    values, modulus = [0] * (d + 1), 1
    for row in sorted(found.collect()):
        p = primes[row.i]
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, row.remainders)]
        modulus *= p
    # The signs alternate; a remainder is known for -v as the modulus less v.
    return [v if (d - k) % 2 == 0 or v == 0 else v - modulus for k, v in enumerate(values)]


def scaled(polynomial, bits):
    """The polynomial whose roots are 2**bits times as large."""
    d = len(polynomial) - 1
    return [c << bits * (d - k) for k, c in enumerate(polynomial)]


def roots_above(polynomial, point):
    """How many roots of a polynomial with real roots only lie above an integer, repeated ones counted as often: the
    changes of sign in the coefficients of the polynomial shifted there."""
    shifted = list(polynomial)
    d = len(shifted) - 1
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            shifted[k] += point * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_at(polynomial, point):
    value = 0
    for c in reversed(polynomial):
        value = value * point + c
    return value


def largest_roots(polynomial, most):
    """The largest positive roots as (root * 2**FRACTION, rounded; how often), falling, ``most`` in all. Roots closer
    than the last bit are one."""
    zeros = next(k for k, c in enumerate(polynomial) if c)
    polynomial = polynomial[zeros:]
    d = len(polynomial) - 1
    if not d:
        return []
    above = max(1, -polynomial[d - 1]) + 1  # The sum of the roots.
    fine = scaled(polynomial, FRACTION)
    stack, found, taken = [(0, above, d, 0, 0)], [], 0
    while stack and taken < most:  # From the top; an interval has the roots in (low, high], in units of 2**-bits.
        low, high, n_low, n_high, bits = stack.pop()
        if n_low == n_high:
            continue
        if n_low - n_high == 1 or (bits == FRACTION and high - low == 1):
            found.append((low << FRACTION - bits, high << FRACTION - bits, n_low - n_high))
            taken += n_low - n_high
            continue
        if high - low == 1:
            more = min(8, FRACTION - bits)
            low, high, bits = low << more, high << more, bits + more
        middle = (low + high) // 2
        n_middle = roots_above(scaled(polynomial, bits), middle)
        stack += [(low, middle, n_low, n_middle, bits), (middle, high, n_middle, n_high, bits)]
    result, left = [], most
    for low, high, times in found:
        if times == 1:
            end = value_at(fine, high)
            while end and high - low > 1:
                middle = (low + high) // 2
                value = value_at(fine, middle)
                if value == 0 or (value > 0) == (end > 0):
                    high, end = middle, value
                else:
                    low = middle
        result.append((high, min(times, left)))
        left -= times
    return result


def null_vectors(matrix, root, times):
    """``times`` orthonormal vectors that the integer matrix maps to root / 2**FRACTION times themselves.

    Elimination of the matrix less the root with FRACTION bits behind the point, a unit of the last bit for a
    vanished pivot; each vector comes from a start of its own in two rounds and is made orthogonal to the earlier ones.
    """
    import random

    import numpy as np
    d = len(matrix)
    a = np.array([[int(x) << FRACTION for x in row] for row in matrix], object)
    a[np.arange(d), np.arange(d)] -= root
    swaps = []
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        swaps.append(pivot)
        a[[k, pivot]] = a[[pivot, k]]
        a[k, k] = a[k, k] or 1
        if k + 1 < d:
            factors = (a[k + 1:, k] << FRACTION) // a[k, k]
            a[k + 1:, k + 1:] -= np.outer(factors, a[k, k + 1:]) >> FRACTION
            a[k + 1:, k] = factors

    def normal(x):
        shift = max(int(v).bit_length() for v in x) - 2 * FRACTION
        return np.array([int(v) >> shift if shift > 0 else int(v) << -shift for v in x], object)

    def solved(b):
        y = np.array(b, object)
        for k in range(d):
            y[[k, swaps[k]]] = y[[swaps[k], k]]
        for k in range(d - 1):  # Rows below; their factors moved along with the swaps.
            y[k + 1:] -= (a[k + 1:, k] * y[k]) >> FRACTION
        y <<= 2 * FRACTION
        for k in range(d - 1, -1, -1):
            y[k] = ((y[k] - (int((a[k, k + 1:] * y[k + 1:]).sum()) if k + 1 < d else 0)) // a[k, k])
        return normal(y)

    starts, found = random.Random(7), []
    for _ in range(times):
        x = np.array([starts.getrandbits(64) - (1 << 63) << FRACTION for _ in range(d)], object)
        for _ in range(2):
            x = solved(normal(x))
            for other in found:
                x = x - other * (x * other).sum() // (other * other).sum()
        found.append(normal(x))
    result = []
    for x in found:
        length = math.isqrt(int((x * x).sum()))
        result.append([int(v) / length for v in x])
    return result


def components(spark, matrix, most):
    """Eigenvalues and unit eigenvectors of a positive semidefinite integer matrix, the largest first, without 0."""
    roots = largest_roots(characteristic_polynomial(spark, matrix), most)
    if not roots:
        return [], []

    def vectors(frames):
        import pandas as pd
        for frame in frames:
            yield pd.DataFrame({"i": frame["id"], "vectors": [null_vectors(matrix, *roots[i]) for i in frame["id"]]})

    found = spark.range(0, len(roots), 1, min(len(roots), spark.sparkContext.defaultParallelism)).mapInPandas(vectors, "i long, vectors array<array<double>>")
    values = [root / (1 << FRACTION) for root, times in roots for _ in range(times)]
    return values, [v for row in sorted(found.collect()) for v in row.vectors]


def whiten(table, most=32, scale=64, offset=1_000_000, id_column="vec_id", vector_column="embedding"):
    """Whitened vectors, one row for each vector and component: vec_id, component (from 1), n, deviation, whitened,
    explained, identity_error.

    A vector's components c become integers x = floor(scale * c) + offset. Over all n vectors with sums S, components are
    the unit eigenvectors of the covariance (divisor n) by falling eigenvalue e, at most ``most``; deviation is the
    exact sum of (n * x - S) ** 2 (NULL beyond a long), whitened (x - S / n) projected on the component over sqrt(e),
    explained e over the sum of all, identity_error the largest entry by which the covariance of ``whitened`` differs from
    the identity, one value for all rows.

    Vectors that are NULL or empty, or hold a NULL, NaN, infinity or a component of 2**38 or more, take no part, and
    neither do vectors of another length than the most frequent one (of equals the greatest). Directions without
    variance are no components, so a table without variance, as an empty one, gives no rows. Equal eigenvalues
    have any orthonormal vectors of their space. Repeated rows and ids, and NULL ids, count row by row; other columns are
    ignored.

    Three narrow passes over the vectors; only d * d sums a task are shuffled. The work on the matrix grows with its
    dimension d (about d**4), not with the rows, and is spread by primes and by components.
    """
    import numpy as np
    spark = table.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = finite_vectors(table, id_column, vector_column)
    size = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if size is None:
        return spark.createDataFrame([], schema)
    dimension = size.d
    rows = rows.filter(F.size("vector") == dimension)
    n, sums, matrix = scatter(rows, dimension, scale)
    values, vectors = components(spark, matrix, most)
    if not values:
        return spark.createDataFrame([], schema)
    projection = np.array(vectors).T / np.sqrt(values)
    explained = np.array(values) / float(int(matrix.trace()))

    def centred(matrix):
        """n * x - S, and the exact sums of squares, None beyond a long; the offset cancels out."""
        if (int(np.abs(matrix).max()) * n + max(abs(s) for s in sums)) ** 2 * dimension < 1 << 63:
            difference = matrix * n - sums.astype("int64")
            return difference.astype("float64"), (difference * difference).sum(axis=1).tolist()
        difference = matrix.astype(object) * n - sums
        squares = [int(s) for s in (difference * difference).sum(axis=1)]
        return difference.astype("float64"), [s if s < 1 << 63 else None for s in squares]

    def moments(batches):
        total = None
        for _, matrix in integer_batches(batches, scale):
            white = centred(matrix)[0] @ projection
            part = np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])
            total = part if total is None else total + part
        return total

    total = np.array(summed(rows, moments, "double")) / n
    mean, square = total[:len(values)], total[len(values):].reshape(len(values), -1)
    identity_error = float(np.abs(square - np.outer(mean, mean) - np.eye(len(values))).max())

    def run(batches):
        import pyarrow as pa
        for ids, matrix in integer_batches(batches, scale):
            difference, squares = centred(matrix)
            white = difference @ projection
            m, k = white.shape
            each = np.repeat(np.arange(m), k)
            columns = [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype="int32"), m)), pa.array(np.full(m * k, n, "int64")),
                       pa.array(squares, pa.int64()).take(pa.array(each)), pa.array(white.ravel()), pa.array(np.tile(explained, m)),
                       pa.array(np.full(m * k, identity_error))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
