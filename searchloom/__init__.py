"""Message-search corpus building and proving on Spark DataFrames."""
