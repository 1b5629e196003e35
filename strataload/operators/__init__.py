"""DataFrame to DataFrame operators; only the sources package writes."""
