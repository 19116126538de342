"""Reading raw exports and reference tables, conforming them, and writing results."""
