"""Incremental file jobs."""

from tidemark.streaming.ingest import ingest_files, read_files, summarize_files
from tidemark.streaming.state import GroupState, summarize_new_files

__all__ = ["GroupState", "ingest_files", "read_files", "summarize_files", "summarize_new_files"]
