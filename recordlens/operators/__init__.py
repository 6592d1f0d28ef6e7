"""Building blocks shared by the jobs: keep-one, marks, joins, domain matching, sinks."""
