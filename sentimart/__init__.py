"""sentimart — market-signal analytics as Spark DataFrame jobs.

Layers (all functions take and return DataFrames, so batch and streaming
share one code path):

* ``sources``    canonical tables, raw landing payloads, JSON parsing, stream sources
* ``functions``  column expressions (enrichment rules, rounding, tokenising)
* ``operators``  silver enrichment, staging projections, roll-ups, dedup,
                 text scoring, data-quality checks, keyed publish
* ``plans``      marts and gold models (joins + composite signals), full build
* ``streaming``  idempotent micro-batch sinks and the streaming jobs
"""

from sentimart.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
