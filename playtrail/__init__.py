"""playtrail: learning analytics over game clickstreams, built on Spark DataFrames.

Layout
------
sources/    readers, writers and the fixture views built from the driver tables
plans/      order-dependent building blocks that stay parallel under skew
operators/  relational, labelling, feature, sequence, model and scoring operators
functions/  column-level helpers (scalar, string, array)
streaming/  (the reference has no streams; see its docstring)
jobs        end-to-end training-table jobs (styles 1-5)
"""

from playtrail.session import configure, get_session

__all__ = ["configure", "get_session"]
