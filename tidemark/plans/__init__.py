"""Layer builds, the batch questions, and the named compositions."""
