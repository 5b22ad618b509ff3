"""Resumable keyed work and stateful listings on Structured Streaming."""
