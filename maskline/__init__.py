"""De-identification and disclosure-risk analytics as native Spark expressions, joins and aggregates."""
