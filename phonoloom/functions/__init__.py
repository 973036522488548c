"""Column expressions: ids, dates, text, lexicons, signals, classifiers."""
