"""Record extraction, landing, parsing, messaging and keyed lookup on Spark DataFrames."""
