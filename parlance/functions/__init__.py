"""Column functions: text, scores, times, codes, rules."""
