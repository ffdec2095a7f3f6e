"""Near-real-time processing: idempotent micro-batches, each a set of batch jobs."""
