"""Discourse coding on Spark: cleaning, history, agreement, retrieval, prompts, votes, reports."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions of this package travel to executors whole, so workers need no copy installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
