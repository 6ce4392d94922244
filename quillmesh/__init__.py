"""quillmesh: Spark-native analytics for web-evidence corpora."""
