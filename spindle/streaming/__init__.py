"""Streaming entry points. The reference's jobs are all batch; the only
streaming surface here is the follower count kept current over a folder
that keeps receiving edge files (same operator, streaming source)."""
