"""Operators for training-data corpora.

Each module holds one operator with its own general interface; ``queries`` binds
them to the given tables.  Nothing outside this subpackage imports it.

Input convention: a documents table has ``doc_id`` (integer), ``text``, and where
an operator says so ``lang`` or ``source``.  Operators read only the columns they
name, so extra columns (also ones that clash with output names) do not matter.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
