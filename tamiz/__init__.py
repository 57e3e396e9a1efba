"""tamiz: data-quality analytics as PySpark DataFrame and Column functions."""
