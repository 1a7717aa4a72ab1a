"""All queries of the engine, by name."""

from . import classification, content, generic, labels_and_latex, layout, records, regions, review  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
