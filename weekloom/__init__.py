"""weekloom: weekly retail demand, forecast and price analytics on Spark DataFrames."""
