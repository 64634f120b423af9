"""Column functions: text, hashing, statistics, intervals."""
