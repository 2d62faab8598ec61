"""Trip-order quality analytics as Spark DataFrame operators."""
