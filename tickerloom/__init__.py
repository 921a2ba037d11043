"""tickerloom: equity signal analytics as PySpark DataFrame transformations.

Operators are pure ``DataFrame -> DataFrame`` functions.  Nothing here collects
data to the driver or runs Python per row; Catalyst picks the physical plan.
"""

__version__ = "0.1.0"

SECURITY = ("gvkey", "iid")
