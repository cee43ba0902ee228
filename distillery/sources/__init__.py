"""Readers and sinks: JSONL samples / scored pairs / triplets, driver tables, fixtures."""
