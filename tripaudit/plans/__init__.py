"""The two reports, composed from operators."""
