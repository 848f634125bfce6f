"""Column functions on dense vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(col: Column) -> Column:
    return col.cast("array<double>")


def total(col: Column) -> Column:
    """Sum of the members."""
    return F.aggregate(_doubles(col), F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    """Inner product."""
    return total(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y))


def l2_norm(col: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(dot(col, col))


def l2_normalize(col: Column) -> Column:
    """Unit vector; a zero vector gives NaN members."""
    size = l2_norm(col)
    return F.transform(_doubles(col), lambda x: F.when(size == 0, F.lit(float("nan"))).otherwise(F.try_divide(x, size)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, -1 where it is undefined (R2 for given pairs, F25)."""
    value = F.try_divide(dot(a, b), l2_norm(a) * l2_norm(b))
    return F.coalesce(F.nanvl(value, F.lit(-1.0)), F.lit(-1.0))


def to_distribution(col: Column) -> Column:
    """Scale members to sum 1."""
    sized = F.transform(F.array(total(col)), lambda size: F.transform(_doubles(col), lambda x: F.try_divide(x, size)))  # the sum is made once, not per member
    return F.element_at(sized, 1)


def kl_distance(p: Column, q: Column, eps: float = 1e-12) -> Column:
    """Smoothed Kullback-Leibler divergence (R9); ``eps=0`` gives the plain form."""
    terms = F.zip_with(_doubles(p), _doubles(q), lambda x, y: x * F.ln((x + F.lit(eps)) / (y + F.lit(eps))))
    return total(terms)


def symmetric_kl(p: Column, q: Column, eps: float = 0.0) -> Column:
    """Mean of the divergence in both directions (R8). This is not the Jensen-Shannon divergence."""
    return (kl_distance(p, q, eps) + kl_distance(q, p, eps)) / F.lit(2.0)


def concat_vectors(*cols: Column) -> Column:
    """One vector from several."""
    return F.concat(*[_doubles(c) for c in cols])


def multi_hot(indices: Column, n: int, oov_slot: bool = False) -> Column:
    """0/1 vector of length ``n`` (``n + 1`` with an unknown-label slot).

    Built from the sorted indices as runs of zeros between ones, one pass over the result. An index outside the
    vector is an error, as a silent drop would hide unknown labels.
    """
    size = n + 1 if oov_slot else n
    bad = F.exists(indices, lambda i: (i < 0) | (i >= size))
    at = F.array_sort(F.array_distinct(F.filter(indices.cast("array<int>"), lambda i: i.isNotNull())))
    zeros = lambda count: F.array_repeat(F.lit(0.0).cast("float"), count.cast("int"))
    one = F.array(F.lit(1.0).cast("float"))
    ends = F.concat(F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), F.array(F.lit(size)))  # where the zeros behind each one end
    runs = F.zip_with(at, ends, lambda i, end: F.concat(one, zeros(end - i - 1)))
    lead = zeros(F.coalesce(F.try_element_at(at, F.lit(1)), F.lit(size)))
    vector = F.concat(lead, F.flatten(F.when(F.size(at) > 0, runs).otherwise(F.array(F.array().cast("array<float>")))))
    return F.when(bad, F.raise_error(F.lit(f"label index outside 0..{size - 1}"))).otherwise(vector)


def focal_terms(y: Column, p: Column, alpha: float = 0.25, gamma: float = 3.0, eps: float = 1e-7) -> Column:
    """Per-label focal cross-entropy terms."""

    def term(yy: Column, raw: Column) -> Column:
        pp = F.greatest(F.least(raw, F.lit(1.0 - eps)), F.lit(eps))
        entropy = -(yy * F.ln(pp) + (1 - yy) * F.ln(1 - pp))
        hit = yy * raw + (1 - yy) * (1 - raw)
        weight = yy * F.lit(alpha) + (1 - yy) * F.lit(1 - alpha)
        return weight * F.pow(1 - hit, F.lit(gamma)) * entropy

    return F.zip_with(_doubles(y), _doubles(p), term)


def focal_loss(y: Column, p: Column, alpha: float = 0.25, gamma: float = 3.0) -> Column:
    """Focal loss of one example, summed over labels (M5)."""
    return total(focal_terms(y, p, alpha, gamma))
