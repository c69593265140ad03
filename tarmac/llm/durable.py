"""Cut a plan's lineage through the folder all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and read back from ``spark.checkpoint.dir``.

    The folder is the session's; only where none is set (tests on one machine) a temporary
    one is used. A lost executor costs no more than what runs at the moment.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tarmac-checkpoint-"))
    return df.checkpoint(eager=True)
