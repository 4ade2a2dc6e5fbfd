"""Column expressions and derived names."""
