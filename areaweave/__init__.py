"""Area statistics as Spark jobs: load, clean, classify, join, report and check."""
