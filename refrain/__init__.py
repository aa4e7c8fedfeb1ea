"""refrain: comment and interaction analytics expressed as Spark DataFrame jobs."""
