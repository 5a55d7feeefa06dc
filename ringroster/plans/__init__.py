"""The datasets and reports, composed from the operators."""
