"""Column-expression helpers shared by the operators.

They encode the missing-value, binning and hashing rules that make Spark
results agree with the pandas semantics the operators reproduce.  All of
them return plain Columns, so they stay inside whole-stage codegen.
"""

from hearth.functions.exprs import *  # noqa: F401,F403
from hearth.functions.exprs import __all__  # noqa: F401
