"""salescp: change points in sales price series, on Spark DataFrames.

Layout:
    sources/    text and fixture readers, sinks
    functions/  column expressions
    operators/  enrich (joins and filters), aggregates, detectors, roll-ups
    plans/      the named queries and their SQL equivalents
"""

import sys as _sys

from .params import Filters

# Functions shipped to Python workers (the per-key DP, user detectors) are
# pickled by value, so executors need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: workers import the package
    pass

__all__ = ["Filters"]
