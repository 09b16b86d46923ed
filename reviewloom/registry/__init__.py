"""Queries over the given tables, each with the SQL that checks it."""

from reviewloom.registry.describe_queries import QUERIES as DESCRIBE
from reviewloom.registry.feature_queries import QUERIES as FEATURES
from reviewloom.registry.row_queries import QUERIES as ROWS
from reviewloom.registry.split_queries import QUERIES as SPLITS
from reviewloom.registry.warehouse_queries import QUERIES as WAREHOUSE

# name -> (function of session and folder, SQL or None)
ALL = {**ROWS, **DESCRIBE, **WAREHOUSE, **SPLITS, **FEATURES}
