"""laketide: data lake operators on PySpark.

Land tables and files, pseudonymise identifiers with keyed tokens, control
disclosure, refine into dimensions, facts and history, report with subtotals,
trends and rankings, link organisations without identities, and cut governed
extracts for side-lake workspaces -- each a function from DataFrames to
DataFrames on Spark's own expressions, joins, windows, sources and MLlib.
"""
