"""Column expressions: typed parsing (P1-P7), row rules (R1-R11), row hash."""
