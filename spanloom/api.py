"""What users of the engine call."""

from spanloom.config import Config, NormRules, load_config
from spanloom.plans.pipeline import Enriched, detect, enrich, enriched_documents, match_lines

__all__ = ["Config", "Enriched", "NormRules", "detect", "enrich", "enriched_documents", "load_config", "match_lines"]
