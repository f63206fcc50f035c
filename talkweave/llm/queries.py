"""Every registered query of this subpackage; importing this module fills the registry."""

from . import align, decontaminate, exact_dedup, langid, lm, mixing, packing, phrases, pii, quality, secrets, sharding, simhash  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
