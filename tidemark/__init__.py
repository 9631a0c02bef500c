"""tidemark: cohort retention and player segmentation on Spark DataFrames."""
