"""Column expressions: text analysis, stop lists and small scalar functions."""
