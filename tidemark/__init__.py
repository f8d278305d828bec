"""tidemark: incremental bronze / silver / gold tables on Spark DataFrames."""
