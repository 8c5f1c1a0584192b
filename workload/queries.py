"""All registered queries."""

from workload import q_kpis, q_quality, q_relational, q_sources, q_star  # noqa: F401
from workload.catalog import CATALOG  # noqa: F401
