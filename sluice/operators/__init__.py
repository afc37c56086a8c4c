"""DataFrame to DataFrame building blocks; none of them starts a streaming query."""
