"""Stateful operators on streams, and the sinks a stream writes to."""
