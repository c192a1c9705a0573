"""Structured Streaming: per-batch, windowed and continuous quotes."""
