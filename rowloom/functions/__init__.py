"""Vector expressions for DataFrames and their SQL-callable registrations."""
