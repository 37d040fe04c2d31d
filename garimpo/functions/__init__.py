"""Column expressions: text folding, rules, dates, keys, similarity."""
