"""Jobs over the test tables, each with an equivalent SQL query."""
