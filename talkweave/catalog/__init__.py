"""All registered queries; importing this package fills the registry."""

from . import (
    agreement,
    cleaning,
    explore,
    features,
    flows,
    joins,
    language,
    ordered,
    prompts,
    retrieval,
    schema,
    scoring,
    sources,
)  # noqa: F401
from .registry import QUERIES, SQL, query  # noqa: F401
