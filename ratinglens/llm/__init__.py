"""Operators for preparing language-model training data, on Spark DataFrames.

Ten operators and the queries that apply them to the driver tables; nothing
else in the library imports this subpackage. Functions that run in Python
workers are shipped by value with the job, so executors need no copy of this
package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
