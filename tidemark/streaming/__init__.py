"""Continuous registration of arrivals and continuous readiness."""

from tidemark.streaming.arrivals import register_arrivals, register_batch
from tidemark.streaming.triggers import emit_triggers

__all__ = ["emit_triggers", "register_arrivals", "register_batch"]
