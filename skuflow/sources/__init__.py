"""Sources: the seven-table operational model and its readers/writers."""
