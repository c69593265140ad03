"""Plans: the model chain, the registered queries and the monthly run.

``models``   lazily built raw → clean → staging → fact → reports chain
``catalog``  one registered query per operator, over the test tables
``oracle``   independent DuckDB statements for the registered queries
``monthly``  ``run_month``: one month from raw files to reports and checks
"""
