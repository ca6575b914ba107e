"""Star-schema reports and the jobs that fill the warehouse."""
