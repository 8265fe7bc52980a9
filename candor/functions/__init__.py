"""Column expressions and skew-safe ranking, sequencing and quantiles."""
