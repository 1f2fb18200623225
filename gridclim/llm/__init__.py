"""Operators for preparing training text: filters, deduplication, scans, tokens.

Nothing else in the package imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Python code of these operators travels with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
