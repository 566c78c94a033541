"""quadra: a Spark-native engine for map features on a quadtree of tiles."""
