"""Real-time snapshots: flattening, latest revision in batch and as a
Structured Streaming job."""
