"""The transfer job as Structured Streaming micro-batches."""
