"""Query catalogue (Spark side) and SQL twins (oracle side).

Importing this package registers every query in ``REGISTRY``.
"""

from lendlake.plans import (  # noqa: F401
    marts_q,
    ranking_q,
    features_q,
    quality_q,
    profile_q,
    metrics_q,
    scoring_q,
    models_q,
    sinks_q,
)
from lendlake.plans.registry import REGISTRY  # noqa: F401
