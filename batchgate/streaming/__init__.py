"""Streaming entry: the same load applied to each micro-batch of file drops."""

from .drops import stream_loads

__all__ = ["stream_loads"]
