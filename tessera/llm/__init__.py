"""Operators for preparing language-model training data.

Nothing else in the library imports this package; the registered queries are
in ``tessera.llm.queries``.
"""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions with the task, so a cluster needs
# no copy of the library on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
