"""lavra: layered (raw -> trusted -> delivery) data integration on Spark.

Every public function takes and returns ``Column`` or ``DataFrame`` objects, so
a job stays one declarative plan until it is written or counted.
"""

from lavra.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
