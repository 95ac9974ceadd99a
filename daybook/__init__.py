"""Daily incident extracts on Spark: land, conform, replace by day, roll up."""
