"""cumload: cumulative-impact analytics over documents and places, on Spark."""
