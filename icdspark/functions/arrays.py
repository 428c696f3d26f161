"""Array expressions used when encoding documents and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from icdspark.functions._util import as_col

# Documents keep their first 2,500 word ids; vector norms get 1e-6.
MAX_DOC_TOKENS = 2500
NORM_EPSILON = 1e-6


def truncate(arr, n: int = MAX_DOC_TOKENS) -> Column:
    """c13: keep the first ``n`` elements."""
    return F.slice(as_col(arr), 1, n)


def pad_to(arr, length, value: int = 0) -> Column:
    """c14: right-pad an array with ``value`` up to ``length`` (a Column or int)."""
    arr = as_col(arr)
    length = F.lit(length) if isinstance(length, int) else as_col(length)
    missing = F.greatest(length - F.size(arr), F.lit(0))
    return F.concat(arr, F.array_repeat(F.lit(value), missing))


def multi_hot(ids, num_labels, text: bool = False) -> Column:
    """c15: 0/1 vector of length ``num_labels`` with ones at ``ids`` (0-based); ``text``: as a string of digits.

    Laid out in runs of zeros that end in a one, so the work is that of writing
    the cells, not a search of the ids for each.
    """
    n = F.lit(num_labels) if isinstance(num_labels, int) else as_col(num_labels)
    n = n.cast("bigint")

    def zeros(count: Column) -> Column:
        count = count.cast("int")
        return F.repeat(F.lit("0"), count) if text else F.array_repeat(F.lit(0), count)

    def laid_out(ones: Column) -> Column:
        gaps = F.transform(ones, lambda at, k: zeros(at - F.coalesce(F.get(ones, k - 1), F.lit(-1)) - 1))
        last = zeros(n - 1 - F.coalesce(F.get(ones, F.size(ones) - 1), F.lit(-1)))
        if text:
            return F.array_join(F.concat(gaps, F.array(last)), "1")
        return F.concat(F.flatten(F.transform(gaps, lambda gap: F.concat(gap, F.array(F.lit(1))))), last)

    inside = F.filter(as_col(ids).cast("array<bigint>"), lambda x: (x >= 0) & (x < n))
    # a lambda's argument is worked out once
    return F.get(F.transform(F.array(F.array_sort(F.array_distinct(inside))), laid_out), F.lit(0))


def l2_normalize(vec, eps: float = NORM_EPSILON) -> Column:
    """c18: divide every element by (L2 norm + eps)."""
    vec = as_col(vec).cast("array<double>")
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x)) + F.lit(eps)
    return F.transform(vec, lambda x: x / norm)
