"""Landing-file readers, keyed tables and the model registry."""
