"""Table builders: silver from raw feeds, gold from silver, and queries over gold."""
