"""Literature-overlap analytics on Spark: citation snowballs, report queries, a result grid and linked filters."""
