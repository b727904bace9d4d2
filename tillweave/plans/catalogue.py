"""All queries over the retail views; importing this registers them."""

from tillweave.plans import campaign, lines  # noqa: F401
from tillweave.plans.registry import QUERIES, SQL  # noqa: F401
