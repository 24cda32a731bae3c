"""Change-data analytics on Spark: keyed tables, point-in-time joins and their repair."""

from tidemark.session import build_session, scratch_dir
from tidemark.specs import TableSpec

__all__ = ["TableSpec", "build_session", "scratch_dir"]
