"""News tables derived from general test tables, for checks and benchmarks."""
