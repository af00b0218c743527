"""prismset: dataset preparation for machine learning on Spark."""
