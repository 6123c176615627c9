"""lakesieve: procurement and catalogue analytics as Spark DataFrame plans."""
