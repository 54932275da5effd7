"""Incremental work: new scenario files as a stream, and change logs between snapshots."""
