"""Queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from workload import control, layers, ledger, locks, scans, scalars, sinks, steps, streams

MODULES = (scans, steps, scalars, control, ledger, locks, layers, sinks, streams)


def collect(attribute: str) -> dict:
    merged: dict = {}
    for module in MODULES:
        for name, value in getattr(module, attribute).items():
            if name in merged:
                raise ValueError(f"{name} registered twice")
            merged[name] = value
    return merged
