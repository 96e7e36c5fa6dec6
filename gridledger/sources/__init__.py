"""Readers of ledgers, mappings and result files."""
