"""tidewell: Spark jobs and DataFrame operators for public-health data.

Landed files are normalised (``plans``), merged into versioned masters
(``operators.upsert``, ``sources.master``), linked to medical codes
(``operators.matching``) and kept in a star schema (``plans.warehouse``,
``plans.enrichment``). Everything takes and returns DataFrames.
"""
