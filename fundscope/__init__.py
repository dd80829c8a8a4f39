"""fundscope: campaign analytics on Spark, from raw files to evaluated models.

Every public function takes and returns DataFrames; nothing is collected to the
driver except small, bounded results (model metrics, bin edges).
"""

from fundscope.session import ensure_checkpoint_dir, get_spark

__all__ = ["get_spark", "ensure_checkpoint_dir"]
