"""Column expressions: text, money and dates. All stay inside Catalyst."""
