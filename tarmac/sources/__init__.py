"""Sources and sinks.

``raw_csv``   monthly CSV → raw rows, bound by header name
``archives``  zipped monthly archives → raw rows, streamed per task
``parquet``   month-partitioned Parquet sinks, load contract, pruning reads
``fixtures``  flights-shaped raw rows derived from the ``lineitem`` table
"""

from tarmac.sources import archives, fixtures, parquet, raw_csv

__all__ = ["archives", "fixtures", "parquet", "raw_csv"]
