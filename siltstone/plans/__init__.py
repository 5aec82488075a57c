"""The layers put together: ingest, silver, wide table, and one business day of it all."""
