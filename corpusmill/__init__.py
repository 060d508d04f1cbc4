"""Corpus classification analytics as DataFrame operators.

``functions`` holds column expressions, ``operators`` DataFrame-to-DataFrame
operators, ``sources`` readers and writers, ``plans`` the named queries with
their SQL, ``streaming`` the Structured Streaming extension.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
