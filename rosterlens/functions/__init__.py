"""Column functions over directory fields."""
