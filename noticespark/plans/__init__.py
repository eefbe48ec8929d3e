"""Per-source batch jobs, sinks and the query registry."""
