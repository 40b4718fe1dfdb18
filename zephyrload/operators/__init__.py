"""Dataset operators: stepped means, joins, upserts, nearest station, audits."""
