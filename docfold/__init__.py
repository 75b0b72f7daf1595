"""docfold: fold semi-structured JSON snapshots into a checked dimensional model on Spark."""
