"""Readers and writers for the feeds and extracts."""
