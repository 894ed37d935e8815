"""All registered queries."""

from cellsurvey.plans import catalog_annotation, catalog_meta, catalog_network, catalog_qc, catalog_sources, catalog_streaming, catalog_summary  # noqa: F401
from cellsurvey.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
