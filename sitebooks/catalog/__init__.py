"""Registered queries: every operator and job on the driver's tables.

``QUERIES[name](spark, sf_dir)`` gives a DataFrame; ``ORACLE[name]`` is the same
result as SQL over the same tables.
"""

from sitebooks.catalog import (  # noqa: F401  (importing registers the queries)
    basics,
    finance,
    ingestion,
    layouts,
    leases,
    lookups,
    mutations,
    plans,
    probes,
    pumps,
    scalars,
    summaries,
)
from sitebooks.catalog.registry import ORACLE, QUERIES  # noqa: F401
