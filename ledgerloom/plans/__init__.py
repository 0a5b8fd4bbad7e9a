"""Named data products (bronze/silver/gold), statements, checks and queries."""
