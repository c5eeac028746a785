"""The latest row per key.

The job form is an aggregate: ``max(struct(order..., payload...))`` per key.
It plans as a partial + final aggregate around one exchange, so a key holding
a large share of all rows is reduced map-side before the shuffle instead of
landing whole in one window task. Ties on the order columns are broken by the
payload itself, so the pick is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def latest_struct(order: Sequence[Column | str], payload: Sequence[str], where: Column | None = None,
                  name: str = "_latest") -> Column:
    """Aggregate expression: the struct of the greatest row by ``order``
    (NULLs lose), restricted to rows matching ``where``."""
    fields = [(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)]
    fields += [F.col(c).alias(c) for c in payload]
    s = F.struct(*fields)
    if where is not None:
        s = F.when(where, s)
    return F.max(s).alias(name)

