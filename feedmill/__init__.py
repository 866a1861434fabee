"""feedmill: feed analytics and text preparation on PySpark DataFrames."""
