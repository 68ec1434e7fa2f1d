"""Jobs on Structured Streaming micro-batches."""
