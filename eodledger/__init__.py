"""Account-ledger operators and the end-of-day equity report on Spark DataFrames."""
