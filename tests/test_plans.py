"""Scale guard over whole plans: those of the returned frames, and those of every table that a query
writes or collects on its way."""

from __future__ import annotations

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter

from conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
#: queries that do much of their work before they return
EAGER = [
    "s1_read_feature_collection", "s3_fetch_objects", "s5_write_tiles", "s6_write_ply", "s7_read_ply", "s7_read_ply_binary", "s8_verify_output",
    "q3_normalized_ply", "j1_match_scenes", "j1_match_footprints", "j2_nearest_label_split", "j3_resample_tiled", "g2_estimate_normals",
    "q2_point_cloud_raw", "q5_surface_faces", "q5_delaunay_report",
]


def recorded(monkeypatch) -> list[str]:
    """The plans of all writes and collects from now on."""
    plans: list[str] = []

    def plan(df) -> None:
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    for name in ("parquet", "save", "text"):
        own = getattr(DataFrameWriter, name)
        monkeypatch.setattr(DataFrameWriter, name, lambda self, *a, _own=own, **k: (plan(self._df), _own(self, *a, **k))[1])
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: (plan(self), collect(self))[1])
    return plans


@pytest.mark.parametrize("name", EAGER)
def test_no_query_multiplies_its_tables_on_the_way(spark, monkeypatch, name):
    from drapekit.registry import QUERIES

    plans = recorded(monkeypatch)
    plans.append(QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 1
    for plan in plans:
        assert not any(node in plan for node in FORBIDDEN), plan
