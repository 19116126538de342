"""Column expressions: text cleaning, date parsing, measures and labels."""
