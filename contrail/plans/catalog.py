"""All registered queries."""

from contrail.plans import queries_columns, queries_joins, queries_models, queries_stats  # noqa: F401
from contrail.plans.registry import QUERIES  # noqa: F401
