"""marquee — Spark-native catalogue analytics.

Parameterised DataFrame operators for tolerant parsing, record matching,
budget imputation, multi-value explosion, dimensional marts, segment ROI,
trends, rankings, profiling and data-quality checks.  Every operator is a
function ``DataFrame -> DataFrame`` built from Spark SQL expressions,
windows, joins and aggregations, so Catalyst and AQE plan the work.
"""

from marquee.config import Scope

__all__ = ["Scope"]
__version__ = "0.1.0"
