"""All registered queries (importing the plan modules registers them)."""

from quire.plans import analysis, cleaning, distributions, judged, models, samples, scalars, texts  # noqa: F401
from quire.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
