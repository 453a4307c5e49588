"""Column expressions: text clean-up, tolerant parsing, clocks and batch ids."""
