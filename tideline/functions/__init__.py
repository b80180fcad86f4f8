"""Column functions: log positions, times, JSON values."""
