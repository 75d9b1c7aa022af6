"""tarn: environmental-monitoring analytics on Spark.

Landed XML measurement responses and GML site catalogs become typed
DataFrames; raw tables are kept with keyed upserts and a change history;
star-schema marts, diagnostics, quality checks and dashboard views are
plain ``DataFrame -> DataFrame`` functions that Catalyst plans end to end.
"""

from tarn.session import get_session

__all__ = ["get_session"]
