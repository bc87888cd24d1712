"""Card-transaction lakehouse operators for Apache Spark."""
