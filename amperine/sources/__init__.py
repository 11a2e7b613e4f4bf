"""Reading tables, payloads and streams."""
