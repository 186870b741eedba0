"""Column functions on vectors and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def valid(v: Column, dim: int) -> Column:
    """Whether a vector has ``dim`` finite values that are not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; 0 where a norm is 0, null where a vector is null or the lengths differ."""
    n = norm(a) * norm(b)
    return F.when(F.size(a) == F.size(b), F.when(n == 0, 0.0).otherwise(F.try_divide(dot(a, b), n)))


def unit(v: Column) -> Column:
    n = norm(v)
    return F.when(n > 0, F.transform(v, lambda x: x.cast("double") / n)).otherwise(F.transform(v, lambda x: x.cast("double")))


def parse(s: Column) -> Column:
    """A vector from a JSON list or from numbers between commas or white space; null where any part is no number."""
    bare = F.regexp_replace(F.trim(s), r"^\[|\]$", "")
    parts = F.filter(F.split(bare, r"[,\s]+"), lambda x: x != "")
    nums = F.transform(parts, lambda x: x.try_cast("double"))
    return F.when((F.size(parts) > 0) & F.forall(nums, lambda x: x.isNotNull()), nums)


def bucket_size(n: Column, bounds: tuple[int, ...] = (16, 32, 48, 64, 84)) -> Column:
    """The least bound that holds ``n``, beyond the last the next multiple of 8."""
    out = F.ceil(n / 8.0) * 8
    for b in reversed(bounds):
        out = F.when(n <= b, b).otherwise(out)
    return out.cast("bigint")


def fuse(dense: Column, lexical: Column, dense_weight: float = 0.65, lexical_weight: float = 0.35) -> Column:
    """Weighted mean of two scores; the dense one alone where the weights sum to nothing."""
    total = dense_weight + lexical_weight
    return (F.lit(dense_weight) * dense + F.lit(lexical_weight) * lexical) / total if total > 0 else dense


def margin_loss(a: Column, p: Column, n: Column, margin: float = 1.0) -> Column:
    """Triplet loss with Euclidean distance."""

    def distance(x: Column, y: Column) -> Column:
        return F.sqrt(F.aggregate(F.zip_with(x, y, lambda i, j: (i.cast("double") - j.cast("double")) * (i.cast("double") - j.cast("double"))), F.lit(0.0), lambda s, v: s + v))

    return F.greatest(F.lit(0.0), distance(a, p) - distance(a, n) + F.lit(margin))
