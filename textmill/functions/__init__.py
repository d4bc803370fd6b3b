"""Column expressions: everything here takes Columns and returns a Column."""
