"""Coordinates and normals for export: casts (P16), normal columns (P18), required columns
(P19), and the full export projection that P17 + P15 + P16 + P18 make together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drapekit.functions.colors import CHANNELS, _positional, quantize_u8, resolve_color_columns

# fixed values: normal column sets tried in this order
NORMAL_SETS = (("nx", "ny", "nz"), ("normal_x", "normal_y", "normal_z"))
XYZ = ("x", "y", "z")


class CloudError(ValueError):
    """A cloud that cannot be exported (missing coordinates or no points)."""


def to_float32(c: Column) -> Column:
    """Export precision."""
    return c.cast("float")


def to_float64(c: Column) -> Column:
    """Working precision."""
    return c.cast("double")


def resolve_normal_columns(columns: list[str]) -> tuple[str, str, str] | None:
    """First complete normal set by exact names, or None."""
    for trio in NORMAL_SETS:
        if all(c in columns for c in trio):
            return trio
    return None


def require_xyz(df: DataFrame, check_empty: bool = True) -> None:
    """Raise when x, y or z is missing, or (``check_empty``) when there are no rows."""
    missing = [c for c in XYZ if c not in df.columns]
    if missing:
        raise CloudError(f"missing required columns: {missing}")
    if check_empty and df.isEmpty():
        raise CloudError("no point cloud data")


def export_frame(df: DataFrame, keep: tuple[str, ...] = ("scene_id",), group: tuple[str, ...] = ("scene_id",)) -> DataFrame:
    """Vertex rows as written to PLY: ``x, y, z`` float32, then ``red, green, blue`` 0..255 when
    a colour source exists, then ``nx, ny, nz`` float32 when normals exist.  Columns in
    ``keep`` (e.g. ``scene_id``) are carried in front for partitioning the sink.

    The colour scale test (P15) uses the largest colour value of each group (each exported
    cloud); it is a small per-group aggregate, broadcast after a size check."""
    require_xyz(df, check_empty=False)
    cols = df.columns
    pdf, colors, _ = resolve_color_columns(df)
    _, pos = _positional(df)
    kept = [c for c in keep if c in cols]
    grp = [c for c in group if c in cols]
    out = [F.col(pos[c]).alias(c) for c in kept] + [to_float32(F.col(pos[c])).alias(c) for c in XYZ]
    if colors is not None:
        integral = all(
            isinstance(
                pdf.select(c).schema[0].dataType,
                (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
            )
            for c in colors
        )
        base = pdf.select(*[F.col(pos[c]).alias(f"_g_{c}") for c in grp], *[c.alias(f"_c{i}") for i, c in enumerate(colors)])
        gcols = [f"_g_{c}" for c in grp]
        cmax = F.greatest(*[F.max(f"_c{i}") for i in range(3)]).alias("_cmax")
        if gcols:
            from drapekit.operators.small import settled

            mx = settled(base.groupBy(*gcols).agg(cmax), "colormax")
            pdf = pdf.join(mx, [pdf[pos[c]].eqNullSafe(mx[f"_g_{c}"]) for c in grp]).drop(*gcols)
            cm = F.col("_cmax")
        else:
            cm = base.agg(cmax).scalar()
        out += [quantize_u8(c, cm, integral).alias(name) for c, name in zip(colors, CHANNELS)]
    normals = resolve_normal_columns(cols)
    if normals is not None:
        out += [to_float32(F.col(pos[c])).alias(n) for c, n in zip(normals, ("nx", "ny", "nz"))]
    return pdf.select(*out)
