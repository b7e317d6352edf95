"""Increments as a stream: each micro-batch of new files is upserted once."""
