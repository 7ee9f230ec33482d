"""Spark operators for labelled signal collections and classical classification.

Every function takes and returns DataFrames (or Columns) and leaves the physical
plan to Spark.  Fitted parameters whose size is fixed by the schema (features x
classes) travel as one-row scalar subqueries or literals; everything that grows
with the rows stays distributed.

Functions of this package that run inside tasks are sent by value, so executors
need no copy of the package on their path.
"""

import os
import sys

# Algebra on the driver is small, tasks have a core each, and the threads of numpy's BLAS do not survive the fork that
# starts the JVM.  Has to be said before numpy is loaded.
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

from pyspark import cloudpickle  # noqa: E402

cloudpickle.register_pickle_by_value(sys.modules[__name__])
