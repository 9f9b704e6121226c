"""Sheaf: harvesting and normalising scholarly-article metadata with Spark.

Raw publisher documents come in as a table; canonical records, quarantined
documents and run accounting go out as tables.  See README.md for a tour.
"""

from sheaf.plans.harvest import harvest, harvest_documents
from sheaf.plans.registry import SourceSpec, register_source, source, sources

__all__ = [
    "SourceSpec",
    "harvest",
    "harvest_documents",
    "register_source",
    "source",
    "sources",
]
__version__ = "0.1.0"
