"""DataFrame operators that take their column names as arguments."""
