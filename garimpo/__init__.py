"""Spark jobs for job-market postings: landing, entity resolution,
classification, star schema, search and quality reports.

Everything is a function from DataFrames to DataFrames.  Dates never come from
the clock: every rolling window takes an explicit ``as_of``.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in Arrow workers travel with the job, so that executors
# need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
