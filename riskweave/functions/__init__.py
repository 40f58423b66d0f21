"""Column expressions: ratios, rules, tokens and stable hashes."""
