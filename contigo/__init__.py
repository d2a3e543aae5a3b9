"""contigo: sequencing-style and tabular analytics as Spark DataFrame plans."""
