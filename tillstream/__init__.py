"""Transaction analytics and alerting as composable Spark DataFrame operators."""
