"""The stages in sequence, each a DataFrame. Nodes are written once to the shared folder when they are first asked for; every
dataset is worked out from there, and nothing else is written before a result is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import compile as C
from quire.operators import graph, layout
from quire.session import hub
from quire.sources.tables import table


class Corpus:
    """The books of a folder of tables, from blocks to datasets."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = lambda name: table(spark, sf_dir, name)
        self._nodes: DataFrame | None = None

    def pages(self) -> DataFrame:
        return layout.pages(self.t("page_data"))

    def blocks(self) -> DataFrame:
        return layout.blocks(self.t("raw_blocks"))

    def furnished(self) -> DataFrame:
        return layout.furniture(self.blocks(), self.pages())

    def ordered(self) -> DataFrame:
        return layout.reading_order(self.furnished())

    def structured(self) -> DataFrame:
        return layout.structure(self.ordered(), self.t("toc"))

    def typed(self) -> DataFrame:
        return layout.typed(self.structured())

    def nodes(self) -> DataFrame:
        if self._nodes is None:
            self._nodes = hub(graph.nodes(self.typed()))
        return self._nodes

    def train(self) -> DataFrame:
        return C.training(self.nodes())

    def titles(self) -> DataFrame:
        """The stem of the path is the title."""
        stem = F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)
        return self.t("books").groupBy("book_id").agg(F.max(stem).alias("book_title"))
