"""Structured Streaming variants of the per-sample stages (the pipelines themselves are
batch; files that keep arriving can be processed incrementally)."""
