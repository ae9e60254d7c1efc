"""Per-input summaries, each one row per customer (or per machine)."""
