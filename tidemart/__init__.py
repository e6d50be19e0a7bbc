"""Commerce stream analytics as DataFrame operators and ready-made plans."""
