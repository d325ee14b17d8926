"""The analytical views, the derived tables, and the queries over the given test tables."""
