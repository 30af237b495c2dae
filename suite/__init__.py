"""The driver's tables recast as flight documents, and the queries over them."""
