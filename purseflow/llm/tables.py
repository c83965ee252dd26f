"""Written intermediate tables in the shared folder, and their removal."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import fresh_path, shuffles_dropped, write_table


class Workspace:
    """Intermediate tables of one operator run, each cutting the lineage before it.

    ``put`` writes and rereads a table; ``drop`` deletes one that no later step reads.
    The folder is the one that ``spark.checkpoint.dir`` names.
    """

    def __init__(self, like: DataFrame, name: str) -> None:
        self.spark = like.sparkSession
        self.root = fresh_path(self.spark, name)
        self.paths: dict[int, str] = {}
        self.count = 0

    def put(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        with shuffles_dropped(self.spark):
            out = write_table(df, path)
        self.paths[id(out)] = path
        return out

    def together(self, *tables: DataFrame) -> DataFrame:
        """The rows of several tables of one schema, by one read."""
        return self.spark.read.schema(tables[0].schema).parquet(*[self.paths[id(df)] for df in tables])

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def steady(documents: DataFrame, name: str) -> DataFrame:
    """``documents`` such that numbering its rows twice gives the same numbers.

    Rows of stored files come in the same order every time they are read. Rows behind a
    shuffle may not, after a lost executor or for other columns, so these are written first.
    """
    plan = documents._jdf.queryExecution().executedPlan().toString()
    return Workspace(documents, name).put(documents) if "Exchange" in plan else documents


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of the table is called so."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name
