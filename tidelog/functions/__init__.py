"""Column expressions: payload codecs, maps, time-ordered UUIDs and clock fields."""
