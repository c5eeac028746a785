"""buyerlens — daily shop-user profile and labelling engine on Spark.

One wide profile row per (tenant, shop user) is built from member and order
snapshots, enriched with order, activity and points aggregates, labelled with
native column expressions, and laid out as sorted sparse
``(rowkey, family, qualifier) -> value`` cells.
"""

from buyerlens.params import ProfileParams

__all__ = ["ProfileParams"]
