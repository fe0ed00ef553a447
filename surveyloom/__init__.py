"""Survey analytics on Spark: harmonise yearly questionnaires, then aggregate them."""
