"""Column expressions and driver-side date arithmetic for split planning."""
