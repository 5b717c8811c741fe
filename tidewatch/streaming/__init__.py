"""Incremental runs: snapshots that pile up and revisions that arrive late."""
