"""The six batch jobs, composed from the operators."""
