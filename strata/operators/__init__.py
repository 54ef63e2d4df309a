"""DataFrame -> DataFrame operators: standardise, cleanse, facts, dimensions, joins."""
