"""What is known before a query runs: fields, schemas, SQL text."""
