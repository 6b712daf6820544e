"""Column -> Column functions and pluggable batch-inference columns."""
