"""Structured Streaming jobs."""

from blockloom.streaming.incremental import incremental_blocks, incremental_instructions, incremental_sources, open_tails

__all__ = ["incremental_blocks", "incremental_instructions", "incremental_sources", "open_tails"]
