"""threadcorpus: language-specific discussion corpora from forum dumps, on Spark.

Every operator is a DataFrame -> DataFrame function (usable with ``.transform``)
or a Column expression; the heavy lifting is left to Catalyst and Tungsten.
"""

from threadcorpus.session import checkpoint_dir, get_session, read_table

__all__ = ["get_session", "checkpoint_dir", "read_table"]
