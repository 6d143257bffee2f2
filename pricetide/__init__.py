"""pricetide: price-movement analytics written as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from pricetide.config import (
    BandRules,
    ChangeRules,
    IndexRules,
    PairRules,
    SkewRules,
    VerdictRules,
)

__all__ = [
    "BandRules",
    "ChangeRules",
    "IndexRules",
    "PairRules",
    "SkewRules",
    "VerdictRules",
]

# The few Python functions that run on executors travel with their tasks, so the
# package has to be importable on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
