"""Reading tables, generating rows, and storing models and metric logs."""
