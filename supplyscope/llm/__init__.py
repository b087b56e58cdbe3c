"""Training-data pipeline operators over document tables.

Every operator takes DataFrames and parameters and returns a DataFrame; the
registered queries are in ``queries``.  The package pickles by value, so
workers need no copy of it on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
