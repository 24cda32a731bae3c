"""Structured Streaming: keyed tables advanced batch by batch, and windowed totals."""
