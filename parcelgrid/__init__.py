"""parcelgrid: geospatial analytics as plain Spark DataFrame and Column code."""
