"""meterflow: utility-billing panels, features, evaluation and serving on Spark DataFrames."""
