"""Operators for training-data pipelines on text tables.

Nothing else in the library imports this subpackage. Operators are functions from
DataFrames to a DataFrame; :mod:`tenorlake.llm.queries` binds them to the test tables.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
