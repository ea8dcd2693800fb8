"""End-to-end plans: the named queries and the batch jobs built from operators."""
