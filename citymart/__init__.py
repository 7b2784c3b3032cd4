"""City analytics on Spark: clean raw city data, build marts, profile, validate and model it."""
