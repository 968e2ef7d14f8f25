"""Column functions: no job, no shuffle, usable in batch and in streams."""
