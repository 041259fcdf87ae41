"""PySpark-native batch analytics: scene metadata, tide heights, class agreement, and corpus operators."""
