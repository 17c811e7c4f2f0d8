"""String functions: item id key (P1), object key of an s3 URL (P2), object resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: URL pattern pieces
S3_PREFIX = "s3://"
# characters a URL parser silently drops before splitting
DROPPED_URL_CHARS = "\t\r\n"


def strip_last_segment(c: Column) -> Column:
    """Drop the last ``_`` and everything after it; unchanged when there is no ``_``."""
    return F.regexp_replace(c, r"_[^_]*$", "")


def _clean(url: Column) -> Column:
    return F.translate(url, DROPPED_URL_CHARS, "")


def object_key(url: Column) -> Column:
    """``s3://bucket/key?q#f`` -> ``key``: scheme, bucket, every leading slash, query and
    fragment removed; strings not starting with ``s3://`` (case-sensitive) are unchanged."""
    return F.when(
        url.startswith(S3_PREFIX), F.regexp_extract(_clean(url), r"^s3://[^/?#]*/*([^?#]*)", 1)
    ).otherwise(url)


def url_bucket(url: Column) -> Column:
    """Authority of an ``s3://`` URL (may be empty), NULL for other strings."""
    return F.when(url.startswith(S3_PREFIX), F.regexp_extract(_clean(url), r"^s3://([^/?#]*)", 1))


def resolve_object(ref: Column, bucket: Column, default_bucket: str | None = None) -> Column:
    """``struct(bucket, key, filename, error)`` for an object reference.

    An explicit non-empty bucket wins; else an ``s3://`` URL's authority, else (for URLs only)
    ``default_bucket``.  A bare key needs an explicit bucket.  ``filename`` is the text after
    the key's last ``/``.  ``error`` is ``NO_BUCKET`` when no bucket is found."""
    is_s3 = ref.startswith(S3_PREFIX)
    explicit = F.when(F.length(bucket) > 0, bucket)
    from_url = F.when(F.length(url_bucket(ref)) > 0, url_bucket(ref))
    fallback = F.lit(default_bucket) if default_bucket else F.lit(None).cast("string")
    chosen = F.when(is_s3, F.coalesce(explicit, from_url, fallback)).otherwise(explicit)
    key = object_key(ref)
    return F.struct(
        chosen.alias("bucket"),
        key.alias("key"),
        F.substring_index(key, "/", -1).alias("filename"),
        F.when(chosen.isNull(), F.lit("NO_BUCKET")).alias("error"),
    )
