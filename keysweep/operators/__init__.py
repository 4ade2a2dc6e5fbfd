"""DataFrame operators: missing keys, counts, latest row, upsert, validation."""
