"""Training-data pipeline operators (documents, vectors, web pages) and their registered queries."""
