"""Watch-list quote snapshot and the message about it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from barloom.operators.quotes import WATCH_LIST, last_per_run, message, of_watched, parse_quotes, watched
from barloom.session import stage
from barloom.sources.sinks import write_stamped

SNAPSHOT_COLUMNS = ("code", "price", "volume", "timestamp", "name")


def quote_snapshot(
    responses: DataFrame, watch: Sequence[Mapping[str, object]] = WATCH_LIST, taken_at: Column | str | None = None
) -> DataFrame:
    """Watched quotes of the successful responses, with run and list position."""
    return watched(parse_quotes(of_watched(responses, watch), taken_at), watch).select(*SNAPSHOT_COLUMNS, "run_ts", "pos")


def snapshot_and_notify(
    responses: DataFrame,
    path: str,
    watch: Sequence[Mapping[str, object]] = WATCH_LIST,
    taken_at: Column | str | None = None,
) -> DataFrame:
    """Store each run's last quote of every watched code and return one message per run
    (``run_ts``, ``message``); sending it is up to the caller.

    A run is the second of ``taken_at``, a column of the responses or now. The quotes are computed
    once, so rows and message agree. A message has a line per watched code at most. No quotes: no row.
    """
    quotes = stage(last_per_run(parse_quotes(of_watched(responses, watch), taken_at)), "quotes")
    chosen = watched(quotes, watch)
    write_stamped(chosen.select(*SNAPSHOT_COLUMNS, "run_ts"), path)
    return message(chosen, ["run_ts"])
