"""Reading delivered files, landing them in Bronze, and the table store."""
