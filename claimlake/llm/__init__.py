"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only if it is present. Functions that run in Python workers travel
with the job by value, so workers need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
