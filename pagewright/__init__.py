"""Page-layout blocks, semantic HTML and document graphs as Spark DataFrames."""
