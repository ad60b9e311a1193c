"""Record linkage and data preparation as Spark plans."""
