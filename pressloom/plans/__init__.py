"""Whole jobs: read, operators, idempotent write, summary. Any scheduler may call them with a run date."""
