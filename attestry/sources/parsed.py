"""Parsed documents and their pages as tables that survive broken writes and join without moving.

Pages lie in hash buckets of (document, page number), sorted inside. A join on these two columns
reads the buckets where they are: only the other side is shuffled, so page text never moves again
after it was stored. A long document spreads over all buckets.

Every write has an id of its own. Its pages go first, its documents last and in one file: that file is
the commit. Pages of a write without it are never read, so a write that died and is repeated leaves no
page twice. ``vacuum`` deletes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from attestry.operators.pages import unparsed
from attestry.session import delete_path
from attestry.sources.tables import read_or_empty

PAGE_KEY = ("parsed_document_id", "page_number")
WRITE = "write_id"


class ParsedStore:
    """The two tables below ``location``; ``buckets`` and the page columns are fixed when it is made.

    Documents have parsed_document_id, document_version_id, configuration_hash and any other columns;
    pages have ``PAGE_KEY`` and any others. The tables' names are only known to the session.
    """

    def __init__(
        self, spark: SparkSession, location: str, documents: StructType, pages: StructType, buckets: int
    ) -> None:
        self.spark, self.location = spark, location.rstrip("/")
        self.document_schema, self.page_schema = documents, pages
        self.pages_path = f"{self.location}/pages"
        self.name = "parsed_pages_" + uuid.uuid5(uuid.NAMESPACE_URL, self.location).hex
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.fields)
        keys = ", ".join(PAGE_KEY)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {WRITE} string) USING parquet"
            f" PARTITIONED BY ({WRITE}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS"
            f" LOCATION '{self.pages_path}'"
        )
        self.buckets = buckets

    def _committed(self) -> DataFrame:
        like = self.spark.createDataFrame([], StructType([*self.document_schema.fields])).withColumn(
            WRITE, F.lit("")
        )
        return read_or_empty(self.spark, f"{self.location}/documents", like)

    def documents(self) -> DataFrame:
        """Documents of all finished writes."""
        return self._committed().drop(WRITE)

    def pages(self) -> DataFrame:
        """Pages of all finished writes; the scan keeps its buckets.

        The ids of finished writes, one per write, become a partition filter.
        """
        self.spark.catalog.refreshTable(self.name)
        writes = [row[0] for row in self._committed().select(WRITE).distinct().collect()]
        rows = self.spark.table(self.name).where(F.col(WRITE).isin(writes)) if writes else (
            self.spark.createDataFrame([], self.page_schema).withColumn(WRITE, F.lit(""))
        )
        return rows.drop(WRITE)

    def write(self, documents: DataFrame, pages: DataFrame, dealt: bool = False) -> DataFrame:
        """Store the parses whose (version, settings) is new, with their pages; returns the others.

        Of several parses of one version and settings the least id is taken. ``dealt`` says that pages
        lie in as many partitions of ``PAGE_KEY`` as there are buckets, for instance because their text
        is formed after that. Then only keys move; pages dealt otherwise give more files, no other rows.
        """
        write_id = uuid.uuid4().hex
        fresh_ids, reused = unparsed(documents, self.documents())
        fresh = documents.join(fresh_ids.select("parsed_document_id"), "parsed_document_id", "left_semi")
        fresh = fresh.select(*self.document_schema.names)
        ids = fresh.select("parsed_document_id")
        if dealt:
            wanted = pages.select(*PAGE_KEY).join(ids, "parsed_document_id", "left_semi")
            unnumbered = pages.where("page_number IS NULL").join(ids, "parsed_document_id", "left_semi")
            kept = pages.join(wanted, list(PAGE_KEY), "left_semi").unionByName(unnumbered)
        else:
            kept = pages.join(ids, "parsed_document_id", "left_semi")
        self._write_pages(kept, write_id, dealt)
        self._write_documents(fresh, write_id)
        return reused

    def _write_pages(self, pages: DataFrame, write_id: str, dealt: bool = False) -> None:
        rows = pages.select(*self.page_schema.names, F.lit(write_id).alias(WRITE))
        rows = rows if dealt else rows.repartition(self.buckets, *PAGE_KEY)
        rows.write.mode("append").insertInto(self.name)

    def _write_documents(self, documents: DataFrame, write_id: str) -> None:
        documents.withColumn(WRITE, F.lit(write_id)).write.mode("append").parquet(f"{self.location}/documents")

    def vacuum(self) -> None:
        """Delete the pages of writes that never finished. No write may be under way."""
        self.spark.catalog.refreshTable(self.name)
        done = self._committed().select(WRITE).distinct()
        dead = self.spark.table(self.name).select(WRITE).distinct().join(done, WRITE, "left_anti")
        for row in dead.collect():
            delete_path(self.spark, f"{self.pages_path}/{WRITE}={row[0]}")
        self.spark.catalog.refreshTable(self.name)

    def drop(self) -> None:
        """Delete both tables."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.location)
