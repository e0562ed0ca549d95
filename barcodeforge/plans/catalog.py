"""Registered queries: one per user-level operator, each with a DuckDB oracle where SQL can
express it. Each query callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole driver tables (through the fixture views); oracles repeat the fixture text as CTEs.

Column names and types are aligned on both sides: counts BIGINT, rounded values DOUBLE.
"""

from __future__ import annotations

from barcodeforge.plans import q_build, q_checklist, q_conflicts, q_homology, q_primers, q_sources  # noqa: F401  (registration)
from barcodeforge.plans.q_conflicts import entry_query  # noqa: F401
from barcodeforge.plans.registry import ORACLES, QUERIES  # noqa: F401
