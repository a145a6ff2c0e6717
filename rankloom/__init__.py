"""rankloom: link ranking, recommendation and text modelling on PySpark DataFrames.

Every matrix is a long (coordinate) DataFrame and every vector a DataFrame
keyed by id, so joins, aggregations and sorts do the linear algebra.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
