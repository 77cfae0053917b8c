"""Scalar functions of the legacy ETL dialect expressed over Spark built-ins.

Every function here maps Columns to a Column; none is a UDF, so all of them
stay inside whole-stage code generation.
"""

from loadworks.functions.scalar import *  # noqa: F401,F403
from loadworks.functions.scalar import __all__  # noqa: F401
