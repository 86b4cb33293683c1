"""All queries of the core library, by name, with their SQL where there is one."""

from __future__ import annotations

from sievework.plans import corpus, datasets, reports, web  # noqa: F401  (they register their queries)
from sievework.plans.register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
