"""Bounding-box strings (P4): ``"min_lon,min_lat,max_lon,max_lat"`` -> four doubles + an
error code, checked in a fixed order.  Invalid requests become rows with an ``error``
instead of exceptions, so one bad request does not stop a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drapekit.functions.footprint import let

# fixed values: error codes, in the order the checks run
BAD_NUMBER = "BAD_NUMBER"
BAD_COUNT = "BAD_COUNT"
LON_RANGE = "LON_RANGE"
LAT_RANGE = "LAT_RANGE"
LON_ORDER = "LON_ORDER"
LAT_ORDER = "LAT_ORDER"

# a decimal number as a float parser accepts it (sign, digits, point, exponent, inf, nan);
# guards the cast, which on its own would also accept Java-style suffixes like "1.0d"
NUMBER_RE = r"(?i)^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)$"
EDGE_SPACE_RE = r"^\s+|\s+$"


def _to_double(s: Column) -> Column:
    unsigned = F.regexp_replace(s, r"^\+", "")
    return F.when(F.lower(unsigned).rlike(r"^-?nan$"), F.lit(float("nan"))).otherwise(unsigned.try_cast("double"))


def parse_bbox(s: Column) -> Column:
    """``struct(min_lon, min_lat, max_lon, max_lat, error)``; coordinates are NULL when
    ``error`` is set."""
    trimmed = F.transform(F.split(s, ","), lambda p: F.regexp_replace(p, EDGE_SPACE_RE, ""))

    def checked(parts: Column, vals: Column) -> Column:
        numeric = F.forall(parts, lambda p: p.rlike(NUMBER_RE))
        a, b, c, d = (vals.getItem(i) for i in range(4))
        error = (
            F.when(~numeric, F.lit(BAD_NUMBER))
            .when(F.size(parts) != 4, F.lit(BAD_COUNT))
            .when(~(a.between(-180.0, 180.0) & c.between(-180.0, 180.0)), F.lit(LON_RANGE))
            .when(~(b.between(-90.0, 90.0) & d.between(-90.0, 90.0)), F.lit(LAT_RANGE))
            .when(a >= c, F.lit(LON_ORDER))
            .when(b >= d, F.lit(LAT_ORDER))
        )

        def bbox(e: Column) -> Column:
            named = zip((a, b, c, d), ("min_lon", "min_lat", "max_lon", "max_lat"))
            return F.struct(*[F.when(e.isNull(), v).alias(n) for v, n in named], e.alias("error"))

        return let(error, bbox)

    return let(trimmed, lambda parts: let(F.transform(parts, _to_double), lambda vals: checked(parts, vals)))


def parse_bbox_frame(df: DataFrame, col: str = "bbox", keep: tuple[str, ...] = ("req_id",)) -> DataFrame:
    """Apply ``parse_bbox`` to a column; keeps ``keep`` columns and flattens the result.  Each text is
    parsed once: a later filter on ``error`` stays above the unnesting."""
    return df.select(*keep, F.inline(F.array(parse_bbox(F.col(col)))))
