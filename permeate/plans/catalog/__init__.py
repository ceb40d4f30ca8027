"""All registered queries."""

from permeate.plans.catalog import (  # noqa: F401
    charts,
    cycles,
    figures,
    fouling,
    learning,
    preparation,
    quality,
    tables,
    windows,
)
from permeate.plans.registry import QUERIES, SQL  # noqa: F401
