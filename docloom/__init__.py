"""docloom: document and knowledge-base processing on PySpark."""
