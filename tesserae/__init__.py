"""tesserae: a PySpark-native engine for tiled population genomics."""
