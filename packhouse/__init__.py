"""Trading analytics for a fresh-produce wholesaler, as Spark jobs."""
