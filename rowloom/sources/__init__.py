"""Reading, generating and storing matrices."""
