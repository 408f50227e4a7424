"""screenlake: Spark-native screening of very large, very imbalanced labelled tables.

Every operator takes and returns DataFrames and is parameterised by column names
(key, group, label, score, text). See README.md for the operator map.
"""

from screenlake.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
