"""Jobs: MLlib stages and the operators put together."""
