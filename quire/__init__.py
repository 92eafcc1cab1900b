"""quire: document-structure analytics on PySpark DataFrames."""
