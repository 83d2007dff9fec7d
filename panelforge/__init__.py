"""panelforge: entity-by-period panel analytics as Spark DataFrame jobs.

Every public operator takes and returns Spark DataFrames. Only parameter-sized
results (p x p matrices, k centroids, level lists, one-row constants) ever reach
the driver; row-level work stays on the executors.
"""

from panelforge.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
__version__ = "0.1.0"
