"""Colour columns: scaling (P13, P14), quantising for export (P15), choosing the colour columns
of a frame (P17) and packing/unpacking a colour triple (P21)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: colour column sets tried in this order, then single-column names
COLOR_SETS = (
    ("red", "green", "blue"),
    ("r", "g", "b"),
    ("R", "G", "B"),
    ("Red", "Green", "Blue"),
)
TUPLE_COLUMN = "color"
OTHER_TUPLE_COLUMNS = ("rgb", "RGB", "colors", "colour")

CHANNELS = ("red", "green", "blue")


def normalize_rgb(c: Column) -> Column:
    """Value / 255."""
    return c.cast("double") / 255.0


def clip_color(c: Column) -> Column:
    """Value / 255 clipped to [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c.cast("double") / 255.0))


def quantize_u8(c: Column, color_max: Column, integral: bool) -> Column:
    """8-bit export value.  When the cloud's largest colour value is <= 1 the colours are
    taken as 0..1 and scaled by 255 (truncating); otherwise integers wrap modulo 256 like an
    unsigned-byte cast, and fractional values are truncated after clamping to 0..255."""
    scaled = F.greatest(F.lit(0), F.least(F.lit(255), F.floor(c.cast("double") * 255))).cast("int")
    if integral:
        kept = c.cast("long").bitwiseAND(F.lit(255)).cast("int")
    else:
        kept = F.greatest(F.lit(0), F.least(F.lit(255), F.floor(c.cast("double")))).cast("int")
    return F.when(color_max <= 1.0, scaled).otherwise(kept)


def pack_color(r: Column, g: Column, b: Column) -> Column:
    """Three channels -> one array."""
    return F.array(r, g, b)


def unpack_color(c: Column) -> list[Column]:
    """Array -> three channels."""
    return [c.getItem(i) for i in range(3)]


def _positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Rename columns by position so that names differing only in case (``r`` and ``R``) stay
    separate even though Spark resolves names case-insensitively."""
    names = [f"_p{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names))


def resolve_color_columns(df: DataFrame) -> tuple[DataFrame, list[Column] | None, str | None]:
    """Choose the colour source by exact (case-sensitive) column names.

    Returns ``(positional_df, [r, g, b] expressions or None, description)``.  A schema-level
    choice; only the last fallback (a list column that must have 3 values in every row) looks
    at the data, at all of it."""
    pdf, pos = _positional(df)
    cols = df.columns
    for trio in COLOR_SETS:
        if all(c in cols for c in trio):
            return pdf, [F.col(pos[c]) for c in trio], ",".join(trio)
    if TUPLE_COLUMN in cols and isinstance(df.schema[cols.index(TUPLE_COLUMN)].dataType, T.ArrayType):
        return pdf, unpack_color(F.col(pos[TUPLE_COLUMN])), TUPLE_COLUMN
    for name in OTHER_TUPLE_COLUMNS:
        if name in cols and isinstance(df.schema[cols.index(name)].dataType, T.ArrayType):
            sizes = pdf.agg(F.min(F.size(F.col(pos[name]))).alias("a"), F.max(F.size(F.col(pos[name]))).alias("b")).first()
            if sizes["a"] == sizes["b"] == 3:
                return pdf, unpack_color(F.col(pos[name])), name
    return pdf, None, None
