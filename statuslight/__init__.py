"""Status reporting for client engagements, written as Spark DataFrame operators."""
