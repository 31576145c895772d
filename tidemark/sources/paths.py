"""Path expressions: normal form, containment, and file names as Spark reports them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def normal(path: Column) -> Column:
    """Resolve `.`, `..` and repeated slashes; a leading slash or scheme stays."""
    head = F.regexp_extract(path, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*/|/)?", 1)
    parts = F.split(F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*/|/)", ""), "/")
    up = F.filter(parts, lambda p: ~p.isin("", "."))
    kept = F.aggregate(
        up, F.array().cast("array<string>"),
        lambda done, p: F.when(p != "..", F.concat(done, F.array(p))).otherwise(
            F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))))
    return F.concat(head, F.array_join(kept, "/"))


def inside(directory: Column, path: Column) -> Column:
    """`path` is strictly below `directory`; both in normal form."""
    return F.startswith(path, F.concat(F.regexp_replace(directory, "/+$", ""), F.lit("/"))) & (path != directory)


def plain(uri: Column) -> Column:
    """A listed file's path without the `file:` scheme local file systems add."""
    return F.regexp_replace(uri, r"^file:/+", "/")


def plain_encoded(uri: Column) -> Column:
    """The same for `_metadata.file_path`, which is percent-encoded."""
    return plain(F.url_decode(F.regexp_replace(uri, r"\+", "%2B")))


def parent(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)
