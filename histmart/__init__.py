"""histmart: nested product snapshots -> daily/monthly history star schema, on Spark.

Every public function takes and returns DataFrames (or Columns); nothing is
collected to the driver except scalar high-water marks and run metrics.
"""

from histmart.session import get_session, shared_path

__all__ = ["get_session", "shared_path"]
