"""All queries of the library's core, and their SQL."""

from __future__ import annotations

from weftline.plans import resolution, training

QUERIES = {**training.QUERIES, **resolution.QUERIES}
ORACLES = {**training.ORACLES, **resolution.ORACLES}
