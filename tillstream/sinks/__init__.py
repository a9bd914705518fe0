"""Writers: message topics, keyed tables, append tables, archives."""
