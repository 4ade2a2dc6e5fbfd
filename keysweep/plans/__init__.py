"""Jobs built from the operators: one table, or all configured tables."""
