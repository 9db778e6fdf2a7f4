"""DataFrame to DataFrame operators, generic in column names."""
