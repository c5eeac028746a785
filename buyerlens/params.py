"""Job parameters: one ``as_of`` day drives every window."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class ProfileParams:
    """Parameters of one daily profile run.

    ``order_days`` and ``activity_days`` are inclusive window lengths ending on
    ``as_of``: the default 360-day order window starts ``as_of - 359``.
    ``tenants`` restricts every input to those ``merchant_num`` values; ``None``
    keeps all tenants. ``n_buckets`` is the number of key ranges of the cell
    sink. Non-member rows all carry ``member_id = 0``: they meet those
    figures by a broadcast when the ``member_id = 0`` rows (one per tenant)
    are within ``hot_broadcast_max_rows`` / ``hot_broadcast_max_bytes``, else
    through a join salted over ``salt_buckets`` tasks. With
    ``nonmember_figures`` off, non-members have no activity and points figures
    (a choice of meaning: the ``member_id = 0`` lists are no buyer's own).
    A (merchant, member) key of more than ``list_rows`` log rows builds its
    time lists day by day, over many tasks.
    """

    as_of: str = "2024-01-30"
    order_days: int = 360
    activity_days: int = 90
    tenants: tuple[str, ...] | None = None
    n_buckets: int = 15
    salt_buckets: int = 64
    hot_broadcast_max_rows: int = 100_000
    hot_broadcast_max_bytes: int = 64 << 20
    nonmember_figures: bool = True
    list_rows: int = 2_000_000
    paid_status: tuple[int, ...] = field(default=(3, 4, 5, 6, 101))

    def __post_init__(self) -> None:
        _dt.date.fromisoformat(self.as_of)
        if self.order_days < 1 or self.activity_days < 1:
            raise ValueError("window lengths must be >= 1 day")
        if not 1 <= self.n_buckets <= 65536:
            raise ValueError("n_buckets must be in [1, 65536]")
        if self.salt_buckets < 1:
            raise ValueError("salt_buckets must be >= 1")

    def _start(self, days: int) -> str:
        d = _dt.date.fromisoformat(self.as_of) - _dt.timedelta(days=days - 1)
        return d.isoformat()

    @property
    def order_start(self) -> str:
        """First day of the order window (inclusive)."""
        return self._start(self.order_days)

    @property
    def activity_start(self) -> str:
        """First day of the activity window (inclusive)."""
        return self._start(self.activity_days)


# Parameters of the test fixtures: the events table spans January 2024 only,
# so the activity window is 10 days instead of 90.
FIXTURE_PARAMS = ProfileParams(as_of="2024-01-30", order_days=360, activity_days=10, n_buckets=15)
