"""Streaming: intentionally empty.

The reference is a batch pipeline with full rebuilds (no incremental load,
watermarks, windows or state), so there is nothing to express with
Structured Streaming here.
"""
