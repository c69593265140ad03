"""DataFrame operators: every public function maps ``DataFrame``s to a ``DataFrame``.

``clean``    raw rows → typed, enriched rows
``staging``  clean rows → keyed staging view (filters, optional dedupe)
``marts``    carrier dimension, flight fact, carrier and monthly reports
``reports``  dashboard reads: views, KPIs, top-N, unpivots, year filter
``quality``  table checks returning failure counts
"""

from tarmac.operators import clean, marts, quality, reports, staging

__all__ = ["clean", "marts", "quality", "reports", "staging"]
