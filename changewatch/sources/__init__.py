"""Source tables: schemas, readers and the queries that cut them down to what reports need."""
