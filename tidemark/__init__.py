"""tidemark: change-data pipelines and keyed change-log tables on Spark.

Every operator is a DataFrame -> DataFrame function (or a thin writer around
one), so the same code serves batch jobs, ``foreachBatch`` streams and the
correctness oracles.
"""

from tidemark.spec import TableSpec

__all__ = ["TableSpec"]
