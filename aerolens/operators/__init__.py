"""Operators: functions from DataFrame to DataFrame (ML fitting aside)."""

from aerolens.operators import distribution, enrich, filters, ml, quality, reports, setops, topk

__all__ = ["distribution", "enrich", "filters", "ml", "quality", "reports", "setops", "topk"]
