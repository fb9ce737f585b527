"""Column expressions and the Arrow kernels behind the few steps Spark has no function for."""
