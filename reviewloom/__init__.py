"""Review analytics as Spark DataFrame jobs.

Layout:

* ``functions``  column expressions (no UDFs)
* ``sources``    readers and writers
* ``operators``  reusable DataFrame operators (joins, ranks, statistics, features)
* ``plans``      the jobs built from them: load, analyse, split, build features
* ``streaming``  the same load on a file stream
* ``registry``   the queries checked against SQL
"""

from reviewloom.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
