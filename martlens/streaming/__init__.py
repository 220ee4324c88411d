"""Structured Streaming forms of the jobs: same transforms, plus watermarks,
checkpoints and idempotent ``foreachBatch`` sinks."""
