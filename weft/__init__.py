"""weft — graph and churn-feature analytics on Spark DataFrames.

Every operator here is a DataFrame / SQL / Structured Streaming / Spark ML
job; nothing is computed on the driver beyond loop control.
"""

from weft.graph import PropertyGraph

__all__ = ["PropertyGraph"]
