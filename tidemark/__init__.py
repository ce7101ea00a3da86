"""Layered, versioned table loads expressed as Spark jobs."""

from tidemark.specs import DestSpec, LayerSpec, SourceSpec

__all__ = ["DestSpec", "LayerSpec", "SourceSpec"]
