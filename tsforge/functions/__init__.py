"""Column-expression helpers and small numeric functions (p-values)."""
