"""Operators for preparing training text. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks bring the code of these modules along, so that executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
