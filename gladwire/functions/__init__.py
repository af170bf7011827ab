"""Column functions: each takes Columns (or names) and gives a Column."""
