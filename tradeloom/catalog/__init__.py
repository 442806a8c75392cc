"""Every operator bound to the test tables.

Importing this package fills the registry; ``__spark_entry__`` hands it out.
"""

from tradeloom.catalog import (  # noqa: F401
    changes,
    documents,
    events,
    generated,
    graph,
    relational,
    rollups,
    scalars,
)
from tradeloom.catalog.base import REGISTRY, Entry, query  # noqa: F401
