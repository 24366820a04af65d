"""pistespark: tagged map features to per-area analytics, as plain Spark DataFrame plans."""
