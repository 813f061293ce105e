"""Plan-time descriptions: schemas and the errors that queries and writes raise."""
