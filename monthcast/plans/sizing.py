"""Tables that several branches of one query read."""

from __future__ import annotations

from pyspark.sql import DataFrame


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small, many-times-referenced table once: an eager
    ``checkpoint()`` into the shared checkpoint folder (never a local
    checkpoint), which also cuts its lineage so a lost executor does not
    recompute the upstream scans."""
    from ..session import checkpoint_root
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
