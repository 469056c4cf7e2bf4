"""Column functions: hash keys, money, dates, frames, text."""
