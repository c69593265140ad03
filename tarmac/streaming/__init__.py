"""Streaming ingest: monthly raw files landing in a folder, processed as they arrive.

``ingest``  file-source stream → ``foreachBatch`` → delivery-replacing tables
"""

from tarmac.streaming.ingest import landed_files, start_ingest

__all__ = ["landed_files", "start_ingest"]
