"""Column expressions: log-line parsing, line formatting, exact rounding."""
