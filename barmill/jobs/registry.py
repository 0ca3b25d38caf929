"""Every registered query of the library, by operator id, with its oracle."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, with_: str | None = None, select: str | None = None) -> Callable:
    """Registers a query; its oracle is `WITH RECURSIVE with_ select`."""

    def take(function: Callable) -> Callable:
        QUERIES[name] = function
        if select is not None:
            ORACLES[name] = (f"WITH RECURSIVE {with_} " if with_ else "") + select
        return function

    return take


from barmill.jobs import bar_queries, measure_queries, monitor_queries  # noqa: E402,F401  they register themselves
