"""Structured Streaming refresh of the analytics table on file arrival."""

from adtrail.streaming.refresh import land_new_files, new_files, read_landed, read_quarantine, refresh

__all__ = ["land_new_files", "new_files", "read_landed", "read_quarantine", "refresh"]
