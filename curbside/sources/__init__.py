"""Reading, conforming and writing tables."""
