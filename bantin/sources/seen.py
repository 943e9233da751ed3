"""URLs seen by earlier crawls: a table, and a mergeable membership filter in front of it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bantin.operators.frontier import unseen_links
from bantin.sources.workspace import materialise

# A block is 8 words of 64 bits, and a URL sets 4 of its bits; about 12 URLs a block.
_WORDS = 8
_PROBES = 4
_URLS_A_BLOCK = 12
_COLUMNS = [f"w{i}" for i in range(_WORDS)]


class SeenSet:
    """The URLs of all crawls so far, in `urls`, and a blocked Bloom filter of them, in `filter`.

    The filter is a table of blocks: (block, eight words), about 43 bits a URL at most. Each crawl adds rows
    of its own; rows of a block merge by OR, whenever they are read. To tell which links are new, links
    meet the blocks, not the table; only links that the filter may know, some in a hundred of the new
    ones, meet the table. A link the filter does not know is surely new.

    A crawl writes its filter rows before its URLs, so one that stopped between the two has only made the
    filter know too much, which costs time but no link. `expected` counts for a new set: it fixes the
    number of blocks. With far more URLs than that the filter knows ever more links wrongly, and
    `rebuild` makes a larger one.
    """

    def __init__(self, spark: SparkSession, path: str, expected: int = 10_000_000) -> None:
        self.spark, self.path, self.expected = spark, path.rstrip("/"), expected

    def _read(self, name: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def urls(self) -> DataFrame:
        """All URLs; one may be there more than once."""
        found = self._read("urls", "url string")
        return self.spark.createDataFrame([], "url string") if found is None else found

    def _size(self) -> tuple[int, int]:
        """Generation of the filter and its number of blocks."""
        sizes = self._read("sizes", "generation int, blocks long")
        last = None if sizes is None else sizes.orderBy(F.desc("generation")).first()
        return (0, max(1, self.expected // _URLS_A_BLOCK)) if last is None else (last.generation, last.blocks)

    def filter_rows(self) -> DataFrame | None:
        """Rows of the filter in use; those of one block are to be merged by OR."""
        return self._read(f"filter-{self._size()[0]}", "block long, " + ", ".join(f"{w} long" for w in _COLUMNS))

    def add(self, urls: DataFrame, url: str = "url") -> None:
        """Add the URLs of a crawl. Adding one again, or a crawl again, changes nothing that is asked."""
        once = materialise(urls.select(F.col(url).alias("url")).where(F.col("url").isNotNull()).distinct())
        generation, blocks = self._size()
        if generation == 0 and self._read("sizes", "generation int, blocks long") is None:
            self._note(0, blocks)
        _filter_of(once, blocks).write.mode("append").parquet(f"{self.path}/filter-{generation}")
        once.write.mode("append").parquet(f"{self.path}/urls")

    def _note(self, generation: int, blocks: int) -> None:
        line = self.spark.createDataFrame([(generation, blocks)], "generation int, blocks long")
        line.coalesce(1).write.mode("append").parquet(f"{self.path}/sizes")

    def rebuild(self, expected: int | None = None) -> None:
        """Write a filter of the URLs there are, with one row a block, and use it from now on."""
        generation, _ = self._size()
        urls = self.urls().distinct()
        blocks = max(1, (expected or max(self.expected, urls.count())) // _URLS_A_BLOCK)
        _filter_of(urls, blocks).write.mode("overwrite").parquet(f"{self.path}/filter-{generation + 1}")
        self._note(generation + 1, blocks)

    def marked(self, links: DataFrame, url: str = "url") -> DataFrame:
        """The links with `maybe_seen`: false if they are surely in no crawl so far."""
        rows = self.filter_rows()
        if rows is None:
            return links.withColumn("maybe_seen", F.lit(False))
        blocks = rows.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in _COLUMNS]).withColumnRenamed("block", "_block")
        asked = [f"_asked_{w}" for w in _COLUMNS]
        own = links.withColumn("_own", _block_of(F.col(url), self._size()[1]))
        own = own.withColumns(dict(zip(asked, _masks(F.col(url)))))
        met = own.join(blocks, F.col("_own") == F.col("_block"), "left")
        known = F.lit(True)
        for w, mask in zip(_COLUMNS, asked):
            known = known & (F.col(w).bitwiseAND(F.col(mask)) == F.col(mask))
        return met.select(*links.columns, F.coalesce(known, F.lit(False)).alias("maybe_seen"))

    def unseen(self, links: DataFrame, url: str = "url") -> DataFrame:
        """Links of no crawl so far, each once, with the least row among its copies; as `unseen_links`.

        The answer is stored: later crawls do not change it.
        """
        return materialise(self.told_apart(links, url))

    def told_apart(self, links: DataFrame, url: str = "url") -> DataFrame:
        """The plan of `unseen`, of which the filter's part has been run."""
        once = unseen_links(links, self.spark.createDataFrame([], "url string").withColumnRenamed("url", url), url)
        marked = materialise(self.marked(once, url))
        new = marked.where("NOT maybe_seen").drop("maybe_seen")
        unsure = marked.where("maybe_seen").drop("maybe_seen")
        known = self.urls().select(F.col("url").alias("_seen"))
        return new.unionByName(unsure.join(known, F.col(url) == F.col("_seen"), "left_anti"))


def _block_of(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    """For each word of the block, the bits that a URL sets in it."""
    bits = F.xxhash64(url, F.lit("bits"))
    places = [F.shiftrightunsigned(bits, 9 * i).bitwiseAND(F.lit(_WORDS * 64 - 1)) for i in range(_PROBES)]
    out = []
    for word in range(_WORDS):
        mask = F.lit(0).cast("long")
        for place in places:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
            mask = mask.bitwiseOR(F.when(F.shiftright(place, 6) == word, bit).otherwise(F.lit(0).cast("long")))
        out.append(mask)
    return out


def _filter_of(urls: DataFrame, blocks: int) -> DataFrame:
    """The filter of some URLs: one row for each block that is not empty."""
    rows = urls.select(_block_of(F.col("url"), blocks).alias("block"), *[m.alias(w) for w, m in zip(_COLUMNS, _masks(F.col("url")))])
    return rows.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in _COLUMNS])
