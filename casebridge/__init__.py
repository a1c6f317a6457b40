"""Record transfer on Spark: link events to people, copy, follow up, triage, notify."""

from casebridge.config import MatchKey, Run, TransferConfig
from casebridge.sources.tables import Tables

__all__ = ["MatchKey", "Run", "Tables", "TransferConfig"]
