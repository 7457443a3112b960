"""gaceta: a news warehouse and text-analytics engine on Spark DataFrames."""
