"""Graph, clustering and classification analytics as Spark DataFrame programs."""
