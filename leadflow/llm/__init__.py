"""Operations of a training-data pipeline on documents and web pages.

Nothing outside this folder imports it.  Each operator is a function from DataFrames to DataFrames;
``queries.py`` applies them to the given tables, ``oracles.py`` holds SQL where SQL can express them.
"""
