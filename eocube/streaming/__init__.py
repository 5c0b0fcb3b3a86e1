"""Structured Streaming: steps of a cube, running totals, the by-day store."""
