"""All registered queries.  Importing the modules registers them."""

from adperf.plans import q_clean, q_features, q_models, q_quality, q_reports, q_streaming, q_tables  # noqa: F401
from adperf.plans.registry import ORACLES, QUERIES  # noqa: F401
