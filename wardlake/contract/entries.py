"""Loads every module that registers queries."""

from __future__ import annotations

from wardlake.contract import (gold, kpis, quality, relational, reports, sinks,  # noqa: F401
                               sources, streams, transforms)


def load() -> None:
    """Importing this module has registered everything."""
