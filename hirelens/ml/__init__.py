"""Three risk classifiers on Spark ML."""
