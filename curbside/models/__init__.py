"""Trip-duration models on Spark ML."""
