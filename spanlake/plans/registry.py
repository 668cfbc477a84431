"""Every registered query of the engine with its oracle SQL."""

from __future__ import annotations

from . import core, extra, files, more

QUERIES = {**core.QUERIES, **more.QUERIES, **files.QUERIES, **extra.QUERIES}
ORACLES = {**core.ORACLES, **more.ORACLES, **files.ORACLES, **extra.ORACLES}
