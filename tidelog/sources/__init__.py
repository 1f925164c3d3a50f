"""Topics, keyed tables and generated rows."""
