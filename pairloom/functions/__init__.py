"""Column functions: text, JSON values, judge responses, statistics, predicates."""
