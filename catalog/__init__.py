"""The registered queries: deliveries derived from the star-schema tables, and one query per operator."""
