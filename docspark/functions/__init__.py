"""Column functions: everything here maps columns to columns and never moves rows."""
