"""clickpulse: e-commerce stream/batch analytics on PySpark DataFrames.

Every operator takes DataFrames and returns DataFrames. Batch operators are
declarative plans that Catalyst optimizes; streaming twins live in
``clickpulse.streaming``.
"""

from clickpulse.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
