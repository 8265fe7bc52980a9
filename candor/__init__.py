"""candor: review-authenticity analytics as composable Spark DataFrame operators."""
