"""All registered queries by name."""

from parcelight.registry import dashboard, extraction, modeling, orders, retrieval, reviews, storage
from parcelight.registry.spec import Spec

SPECS: dict[str, Spec] = {
    **reviews.SPECS,
    **orders.SPECS,
    **dashboard.SPECS,
    **modeling.SPECS,
    **retrieval.SPECS,
    **extraction.SPECS,
    **storage.SPECS,
}
