"""Every query of the library, by name, with its SQL twin."""

from __future__ import annotations

from prismset.plans import formats, images, relational

QUERIES = {**relational.QUERIES, **formats.QUERIES, **images.QUERIES}
ORACLES = {**relational.ORACLES, **formats.ORACLES, **images.ORACLES}
