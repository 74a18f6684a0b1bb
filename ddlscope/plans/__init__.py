"""The steps of an import put together out of the operators."""
