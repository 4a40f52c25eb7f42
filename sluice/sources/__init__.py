"""Sources by type name. ``register`` adds one; the built-in ones register on import."""

from sluice.sources.registry import ReadContext, read_source, register, source_types
from sluice.sources import documents, files, jdbc, rest  # noqa: F401  (they register themselves)

__all__ = ["ReadContext", "read_source", "register", "source_types"]
