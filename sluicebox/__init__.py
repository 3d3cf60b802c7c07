"""sluicebox: a medallion (bronze, silver, gold) analytics engine on Spark DataFrames."""
