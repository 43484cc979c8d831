"""Training-data operators: text, page, conversation and vector jobs on Spark."""
