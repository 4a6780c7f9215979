"""castwright: source content to spoken-script data with PySpark.

Subpackages: ``functions`` (column functions), ``sources`` (pages, files, transcripts),
``operators`` (intake, events, routing, prompts, turns, chunking, speech, ledger, ordering),
``streaming`` (continuous intake), ``plans`` (registered queries, DuckDB statements, runs).
"""

__version__ = "0.1.0"
