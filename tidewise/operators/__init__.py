"""DataFrame to DataFrame transformations, shared by batch and stream."""
