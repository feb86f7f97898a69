"""textloom: corpus analytics, sampling, conversion and scoring on PySpark."""
