"""codefacts: source-code facts as Spark DataFrames.

Text extraction (``functions`` and ``operators``) turns a ``files`` table
``(path, content)`` into flat fact tables with native Spark expressions;
relational operators link and audit those facts with joins, aggregations
and windows. Every operator is a plain function ``DataFrame(s) -> DataFrame``.
"""

from codefacts.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
