"""headway: public-transport reliability jobs on Spark DataFrames."""
