"""Grouped ordered concatenation (per-key string aggregation with a total order)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_concat(values: Column | str, order: Sequence[Column | str], sep: str) -> Column:
    """Aggregate expression: join ``values`` with ``sep`` sorted by ``order`` (then value).

    Built from ``collect_list`` of structs + ``array_sort`` so the result does
    not depend on shuffle arrival order.  Partial aggregation still happens
    map-side (Spark merges per-task partial lists before the shuffle).
    """
    v = F.col(values) if isinstance(values, str) else values
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    fields = [k.alias(f"k{i}") for i, k in enumerate(keys)] + [v.alias("v")]
    collected = F.array_sort(F.collect_list(F.struct(*fields)))
    return F.array_join(F.transform(collected, lambda s: s["v"]), sep)

