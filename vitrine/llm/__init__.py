"""Operators for preparing language-model training data.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
``queries.py`` registers one query per operator.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are sent whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
