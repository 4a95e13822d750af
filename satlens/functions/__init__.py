"""Column-expression helpers: row-level (``scalar``) and aggregate (``aggregates``)."""

from satlens.functions import aggregates, scalar  # noqa: F401
