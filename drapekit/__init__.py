"""drapekit: satellite images draped over elevation grids as coloured point clouds, on Spark.

Every operator is a plain function ``DataFrame(s) -> DataFrame``; nothing runs until an
action, so a whole pipeline is one Catalyst plan.  Frames carry ``scene_id`` so one job can
handle many scenes.

Sub-packages:

* ``sources``   - catalogue items, object bytes, raster rows, elevation cells, PLY files
* ``functions`` - column expressions (ids, URLs, bbox strings, colours, grid positions)
* ``operators`` - joins, aggregates, windows, sampling, geometry
* ``plans``     - the composed user-level jobs (scene search, point cloud, crop/merge, surface)
"""

from drapekit.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
