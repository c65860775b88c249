"""Stream questions, stream runners and idempotent window sinks."""
