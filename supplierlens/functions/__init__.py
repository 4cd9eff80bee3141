"""Column helpers: every text, number and date rule lives here once."""
