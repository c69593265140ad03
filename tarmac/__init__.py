"""tarmac: airline on-time performance analytics on Spark.

Raw monthly files → clean, enriched month partitions → keyed staging view →
flight fact joined to a carrier dimension → carrier and monthly reports,
dashboard reads and data-quality checks. Every step is a ``DataFrame``
function over built-in expressions, so Catalyst plans the whole path.
"""

__version__ = "0.1.0"
