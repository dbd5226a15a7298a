"""Customer-churn features, training, evaluation and batch scoring as Spark jobs."""
