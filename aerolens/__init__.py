"""aerolens: flight on-time analytics as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame`` (ML fitting aside):
no actions inside operators, no shared temp views, no driver-side loops over
data. Catalyst plans the work; results stay DataFrames until the caller
writes or collects them.

Subpackages
-----------
sources    declared schemas, CSV/Parquet scans, the derived fixture views, sinks
functions  column expressions (calendar, season, part of day, delay label)
operators  quality checks, filters, lookup join, reports, distribution, ML
plans      named queries over the driver's tables and their oracle SQL, the
           single-pass (grouping sets) report suite, model flows and the
           end-to-end report run over real files (also a CLI)
streaming  incremental ingest of newly arriving yearly files
"""

from aerolens.session import build_session, checkpoint_dir, stable

__all__ = ["build_session", "checkpoint_dir", "stable"]
