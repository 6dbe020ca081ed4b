"""tierflow: layered (raw -> bronze -> silver -> gold) analytics on Spark DataFrames.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark's own expressions; models are small compositions of operators.
"""

from tierflow.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]
