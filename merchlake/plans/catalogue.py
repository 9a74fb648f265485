"""All registered queries; importing a plan module registers its queries."""

from merchlake.plans import commerce, dimensions, documents, logs, series, streams  # noqa: F401
from merchlake.plans.registry import ORACLE, QUERIES  # noqa: F401
