"""Column expressions: event schema, JSON codec, row-key text, durations."""
