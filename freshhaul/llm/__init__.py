"""Operators for training-data pipelines over documents and web pages.

Functions that run inside tasks are shipped by value, so executors need neither the
repository on their path nor a package archive.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
