"""Per-scene tables, settled before they meet the points.

Header rows, per-cloud statistics and colour ranges have one row per scene.  They are written
once to the shared folder and read back, so the planner knows their size in bytes: it
broadcasts them below the session's ``spark.sql.autoBroadcastJoinThreshold`` and joins them by
shuffle above it, where AQE splits scenes that hold many points.  No row count decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from drapekit.session import scratch_path


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
