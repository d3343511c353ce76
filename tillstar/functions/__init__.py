"""Column expressions: text, calendar, money and content keys."""
