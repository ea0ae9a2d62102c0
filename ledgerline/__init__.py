"""ledgerline: multi-tenant ingestion and merge operators on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark's
built-in expressions, so Catalyst can prune, push down and codegen the whole
plan.  Driver-side Python only ever walks schemas, column names and file
names, never rows.
"""

from ledgerline.session import build_session, scratch_dir  # noqa: F401

__all__ = ["build_session", "scratch_dir"]
