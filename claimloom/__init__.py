"""claimloom: a Spark-first engine that weaves disagreeing sources into one catalogue."""
