"""Weight vectors: pruning and quantization inside the row, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runestone.functions.arrays import let

# Fixed values of IEEE half precision.
HALF_MIN_EXPONENT = -14
HALF_FRACTION_BITS = 10
HALF_OVERFLOW = 65520.0


def check_sparsity(sparsity: float) -> None:
    if not 0.0 <= sparsity < 1.0:
        raise ValueError("sparsity must be in [0, 1)")


def prune(values: Column, sparsity: float) -> Column:
    """Zero the entries whose magnitude is at most the k-th smallest, k = floor(s * size)."""
    check_sparsity(sparsity)

    def cut(v: Column) -> Column:
        k = F.floor(F.lit(float(sparsity)) * F.size(v)).cast("int")
        threshold = F.get(F.sort_array(F.transform(v, F.abs)), k - 1)
        return let(threshold, lambda t: F.when(
            k > 0, F.transform(v, lambda x: F.when(F.abs(x) > t, x).otherwise(F.lit(0.0).cast("float")))
        ).otherwise(v))

    return let(values, cut)


def half(value: Column) -> Column:
    """One number rounded to half precision (ties to even), as a float again."""
    x = value.cast("double")
    magnitude = F.abs(x)
    # log2 can land on the next power of two for a number just below it.
    guess = F.floor(F.log2(magnitude)).cast("double")
    exponent = F.when(F.pow(F.lit(2.0), guess) > magnitude, guess - 1).otherwise(guess)
    step = F.pow(
        F.lit(2.0),
        F.greatest(exponent, F.lit(float(HALF_MIN_EXPONENT))) - F.lit(float(HALF_FRACTION_BITS)),
    )
    return (
        F.when(magnitude.isNull() | F.isnan(x) | (magnitude == 0), x)
        .when(magnitude >= HALF_OVERFLOW, F.signum(x) * F.lit(float("inf")))
        .otherwise(F.rint(x / step) * step)
        .cast("float")
    )


def half_precision(values: Column) -> Column:
    return F.transform(values, half)


def int8_scale(values: Column) -> Column:
    """Symmetric scale of one tensor; 0 for a tensor of zeros."""
    return F.array_max(F.transform(values, F.abs)).cast("double") / F.lit(127.0)


def int8_codes(values: Column, scale: Column) -> Column:
    """Codes -127..127, ties to even."""
    return let(scale, lambda s: F.transform(values, lambda x: F.when(
        s > 0, F.rint(x.cast("double") / s)).otherwise(F.lit(0.0)).cast("tinyint")))


def int8_restore(codes: Column, scale: Column) -> Column:
    return let(scale, lambda s: F.transform(codes, lambda q: (q.cast("double") * s).cast("float")))


def zero_count(values: Column) -> Column:
    return F.size(F.filter(values, lambda x: x == 0))
