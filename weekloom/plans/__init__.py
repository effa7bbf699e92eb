"""End-to-end compositions of the operators."""

from weekloom.plans.panel import assemble_final, build_enriched_panel, publish  # noqa: F401
from weekloom.plans.collection import (  # noqa: F401
    entity_enrichment, pages_to_observations, quality_and_progress_reports, uploads_to_observations,
)
