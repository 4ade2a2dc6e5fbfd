"""Readers of the source, the target and the table configuration."""
