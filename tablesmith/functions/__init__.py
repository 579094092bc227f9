"""Column-level building blocks: values, predicates, orderings, text functions, the SQL guard."""
