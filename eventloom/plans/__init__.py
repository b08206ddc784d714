"""Named queries over the test tables."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("core", "check_queries", "record_queries", "log_queries", "result_queries",
            "flow_queries", "stream_queries")


def _load() -> None:
    for name in _MODULES:
        import_module(f"eventloom.plans.{name}")


def all_queries():
    from eventloom.plans.catalog import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles():
    from eventloom.plans.catalog import ORACLES

    _load()
    return dict(ORACLES)
