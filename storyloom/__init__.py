"""storyloom: analytics on large collections of serialized text, as DataFrame operators on Spark."""
