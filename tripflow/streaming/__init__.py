"""Incremental ingest and incremental loads with Structured Streaming."""

from tripflow.streaming.content import gather_new_content
from tripflow.streaming.ingest import ingest_new_files
from tripflow.streaming.serving import FolderSink, JdbcSink, ServingSink, load_new_rows

__all__ = ["FolderSink", "JdbcSink", "ServingSink", "gather_new_content", "ingest_new_files", "load_new_rows"]
