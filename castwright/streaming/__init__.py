"""Structured Streaming request intake."""
