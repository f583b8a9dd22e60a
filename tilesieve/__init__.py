"""tilesieve: choose a small, representative subset of a tile collection with Spark.

The package works on DataFrames only.  ``sources`` reads and writes the tables of the workflow,
``functions`` holds column expressions, ``operators`` the joins, rankings, clusterings and
reports, ``plans`` the jobs that string them together and ``catalog`` the registered queries.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

__version__ = "0.1.0"

# Functions of this package travel with the tasks that use them, so executors need no copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
