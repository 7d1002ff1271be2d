"""Feed analytics as plain Spark DataFrame and Column functions."""
