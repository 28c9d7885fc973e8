"""Sinks: JSONL, Markdown statistics, dataset card, review queue."""
