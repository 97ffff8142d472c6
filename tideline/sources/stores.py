"""Stores by URI."""

from __future__ import annotations

import pyarrow.fs as pafs

#: Schemes that Spark's connectors use and that Arrow knows by another name.
ALIASES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(uri: str) -> str:
    scheme, mark, rest = uri.partition("://")
    return f"{ALIASES.get(scheme.lower(), scheme)}{mark}{rest}"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a URI or local path, and the path inside it."""
    return pafs.FileSystem.from_uri(arrow_uri(uri))


def uri_prefix(uri: str, path: str) -> str:
    """What comes before a store's paths to give URIs of the caller's scheme."""
    whole, known = uri.rstrip("/"), path.rstrip("/")
    return whole[: len(whole) - len(known)] if whole.endswith(known) else ""
