"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from supplyscope.functions.columns import *  # noqa: F401,F403
