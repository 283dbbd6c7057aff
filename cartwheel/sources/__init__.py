"""Reading drops, landing and loading tables, audit records, schema drift."""
