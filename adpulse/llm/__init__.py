"""Operators over text corpora: documents, pages and their labels."""

import sys

from pyspark import cloudpickle

# Tasks get the code of this subpackage with them, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
