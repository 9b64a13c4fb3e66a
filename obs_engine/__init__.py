"""Daily observation analytics on Spark: shaping, upserts, ranks, counts and flags."""
