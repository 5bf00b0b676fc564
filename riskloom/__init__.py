"""Credit-risk feature building, scoring, evaluation and monitoring on Spark."""
