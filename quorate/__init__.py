"""quorate: replicated, versioned wide-column data as Spark DataFrames."""
