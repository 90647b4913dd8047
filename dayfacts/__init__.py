"""dayfacts: Spark operators that turn irregular observations into trustworthy daily facts."""
