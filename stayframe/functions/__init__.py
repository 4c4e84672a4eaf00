"""Column helpers: time, text and number rules shared by the operators."""
