"""Tunables of the mart in one place; every operator takes them as arguments."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Defaults are the production values; tests and demos widen the windows."""

    #: session time zone used for every date, day and window string
    zone: str = "Asia/Shanghai"
    #: tumbling window of all marts
    window: str = "10 seconds"
    #: out-of-orderness allowed on the marts' inputs
    delay: str = "2 seconds"
    #: the traffic mart waits for the bounce horizon ...
    traffic_delay: str = "15 seconds"
    #: ... and revises windows it has emitted for so long
    traffic_lateness: str = "2 seconds"
    #: a session start with no follow-up for this long is a bounce
    bounce_horizon_ms: int = 15_000
    #: how far apart the sides of an order join may lie in event time
    order_retention: str = "905 seconds"
    #: the same for refunds and refund payments
    refund_retention: str = "5 seconds"
    #: the SKU mart takes the first version of a detail; with a number, the newest that comes
    #: within so many ms of it by the clock
    sku_hold_ms: int | None = None
    #: a user away for longer than this counts as returning
    back_after_days: int = 7
    #: a side is broadcast only when it is known to be at most this large
    broadcast_bytes: int = 64 * 1024 * 1024
    #: ... or, where no size is known, when it has at most this many rows
    broadcast_rows: int = 200_000
    #: whether a dimension row whose source row is deleted goes too
    honour_deletes: bool = False
    #: the dimension store folds its batches every so many of them; None: never
    compact_every: int | None = 1000
    #: partitions of keyed state, fixed for the life of a checkpoint; None: the cores of a
    #: local session, or STATE_PARTITIONS on a cluster
    state_partitions: int | None = None
    #: slots that keys of order and first-of-day state are dealt to, fixed for the life of a
    #: checkpoint; a micro-batch rewrites the slots it touches
    state_slots: int = 16_384
    #: rows of input that a stream drained to its end holds at once; with more it is drained in
    #: pieces of its keys
    drain_rows: int = 60_000_000
    #: pieces a hot key is cut into where a join needs an explicit salt
    salts: int = 8


    @property
    def revision_delay(self) -> str:
        """How late a row may come that has waited for both its promotions."""
        number, unit = self.order_retention.split()
        wait, delay_unit = self.delay.split()
        return f"{2 * int(number)} {unit} {wait} {delay_unit}"


DEFAULTS = Settings()

#: state partitions on a cluster, whose cores may not have registered at start
STATE_PARTITIONS = 200
