"""Scans: parquet tables, the order-item mapping, CSV readers (SRC1-7)."""

from supplyscope.sources.tables import *  # noqa: F401,F403
