"""marlstone: a document-corpus analytics engine on Spark DataFrames."""
