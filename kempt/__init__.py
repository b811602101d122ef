"""kempt: data cleansing, profiling and reshaping as plain Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function on public PySpark APIs.
Pipelines are ordered lists of operators folded with ``DataFrame.transform``.
"""

from kempt.session import checkpoint_root, drop_scratch, get_spark, materialize, scratch_dir

__all__ = ["checkpoint_root", "drop_scratch", "get_spark", "materialize", "scratch_dir"]
