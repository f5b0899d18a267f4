"""Order analytics and cohort lifetime value as Spark DataFrame transformations."""
