"""govframe: governed tables on Spark DataFrames.

Constraint validation, change-as-transform, row-level security, audit
analytics, history and quality reports, built from Spark's own DataFrame
and SQL functions.  See README.md.
"""

__version__ = "0.1.0"
