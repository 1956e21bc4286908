"""Driver tables mapped to the raw shop entities, for the registered queries and tests."""
