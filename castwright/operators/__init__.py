"""Operators over job tables: intake, events, routing, prompts, turns, chunking, speech, ledger."""
