"""Column expressions: buckets, guarded ratios, number formatting, stamps."""
