"""Operators for preparing large text corpora for model training.

Nothing outside this folder imports it; ``queries.py`` holds the registered
queries and ``sql.py`` the SQL that checks those which SQL can express.
"""
