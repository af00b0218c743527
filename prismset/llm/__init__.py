"""Operators for large text and embedding corpora.

Nothing else in the library imports this subpackage. Its Python functions are
shipped to executors by value, so workers need no copy of the package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

import prismset

cloudpickle.register_pickle_by_value(sys.modules[prismset.__name__])
