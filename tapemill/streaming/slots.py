"""One intraday slot and one daily close, in the order their inputs need.

A slot reads whole hours again, upserts them and recomputes the day, so late or repeated files
need no state between slots: the tables are the state.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from tapemill import jobs
from tapemill.jobs import Lake


def run_calendar(lake: Lake, day: date, run_id: str, ingest_ts: datetime | None = None) -> None:
    """The day's corporate events, before any slot that enriches trades with them."""
    jobs.ingest_events(lake, day, run_id, ingest_ts)
    jobs.promote_events(lake, day, run_id)


def run_slot(
    lake: Lake, day: date, hours: Iterable[int], run_id: str, ingest_ts: datetime | None = None
) -> dict[str, int]:
    """Ticks of some hours through to minute bars and spreads; returns the day's gold row counts."""
    hours = list(hours)
    counts = {}
    jobs.ingest_trades(lake, day, hours, run_id, ingest_ts)
    if jobs.promote_trades(lake, day, run_id):
        jobs.compute_gold(lake, day, "ohlcv", run_id)
        counts["ohlcv"] = jobs.check_gold_rows(lake, day, "ohlcv")
    jobs.ingest_quotes(lake, day, hours, run_id, ingest_ts)
    if jobs.promote_quotes(lake, day, run_id):
        jobs.compute_gold(lake, day, "spread", run_id)
        counts["spread"] = jobs.check_gold_rows(lake, day, "spread")
    return counts


def run_close(lake: Lake, day: date, run_id: str) -> dict[str, int]:
    """Daily VWAP and event windows after the last slot."""
    counts = {}
    for mode in ("vwap", "event_windowed"):
        jobs.compute_gold(lake, day, mode, run_id)
        counts[mode] = jobs.check_gold_rows(lake, day, mode)
    return counts
