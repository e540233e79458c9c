"""The page frontier and kind descriptions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import rollbook
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
    LessThan, LessThanOrEqual, StringStartsWith,
)

from rollbook.sources.sites import SITES, Site

# What runs in tasks travels with its code: executors need not have the package.
cloudpickle.register_pickle_by_value(rollbook)

FRONTIER = "site string, kind string, kinddesc string, kind_no int, page int, domain string, url string"
SITE_TABLE = (
    "site string, domain string, url_head string, url_tail string, "
    "kinds array<struct<kind:string,kinddesc:string>>, first_page int, last_page int"
)


def site_table(spark: SparkSession, sites: Sequence[Site] = SITES) -> DataFrame:
    rows = [
        (s.name, s.domain, s.url_head, s.url_tail, list(s.kinds), s.first_page, s.last_page)
        for s in sites
    ]
    return spark.createDataFrame(rows, SITE_TABLE)


def seed_frontier(sites: DataFrame) -> DataFrame:
    """One row per (site, kind, page): two explodes inside each site row, no shuffle."""
    per_kind = sites.select("*", F.posexplode("kinds").alias("kind_no", "k"))
    per_page = per_kind.select(
        "*", F.explode(F.sequence("first_page", "last_page")).alias("page")
    )
    return per_page.select(
        "site",
        F.col("k.kind").alias("kind"),
        F.col("k.kinddesc").alias("kinddesc"),
        "kind_no",
        "page",
        "domain",
        F.concat("url_head", "k.kind", "url_tail", F.col("page").cast("string")).alias("url"),
    )


def with_kinddesc(df: DataFrame, kinds: Sequence[tuple[str, str]], kind: str = "kind") -> DataFrame:
    """Description of a kind; null for a kind that is not listed."""
    table = F.create_map(*[F.lit(part) for pair in kinds for part in pair])
    return df.withColumn("kinddesc", F.try_element_at(table, F.col(kind)))


def register(spark: SparkSession, sites: Sequence[Site] = SITES) -> None:
    """S1 as a source: ``spark.read.format("frontier").load()`` has the pages of ``sites``, one
    partition a site. Filters on its columns are evaluated by the source, so a site, kind or
    page that no filter lets through is never made."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    listed = tuple(sites)

    class Frontier(DataSource):
        @classmethod
        def name(cls) -> str:
            return "frontier"

        def schema(self) -> str:
            return FRONTIER

        def reader(self, schema) -> DataSourceReader:
            return FrontierReader(listed)

    spark.dataSource.register(Frontier)


class SitePartition(InputPartition):
    def __init__(self, site: Site):
        super().__init__(site.name)
        self.site = site


class FrontierReader(DataSourceReader):
    def __init__(self, sites: Sequence[Site]):
        self.sites = sites
        self.tests: list[tuple[str, Callable]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes over what compares one column with values; gives back the rest."""
        for f in filters:
            if isinstance(f, IsNotNull):  # nothing here is null
                continue
            test = _TESTS.get(type(f))
            if test is None or len(f.attribute) != 1:
                yield f
            else:
                self.tests.append((f.attribute[0], partial(test, f.value)))

    def _passes(self, **known) -> bool:
        return all(test(known[name]) for name, test in self.tests if name in known)

    def partitions(self) -> list[InputPartition]:
        wanted = [s for s in self.sites if self._passes(site=s.name, domain=s.domain)]
        return [SitePartition(s) for s in wanted]

    def read(self, partition: SitePartition | None) -> Iterator[tuple]:
        if partition is None:  # no site passes the filters
            return
        site = partition.site
        for number, (kind, kinddesc) in enumerate(site.kinds):
            if not self._passes(kind=kind, kinddesc=kinddesc, kind_no=number):
                continue
            for page in range(site.first_page, site.last_page + 1):
                url = f"{site.url_head}{kind}{site.url_tail}{page}"
                if self._passes(page=page, url=url):
                    yield site.name, kind, kinddesc, number, page, site.domain, url


#: How the source evaluates a filter: the filter's value, then the column's.
_TESTS = {
    EqualTo: lambda wanted, value: value == wanted,
    In: lambda wanted, value: value in wanted,
    GreaterThan: lambda low, value: value > low,
    GreaterThanOrEqual: lambda low, value: value >= low,
    LessThan: lambda high, value: value < high,
    LessThanOrEqual: lambda high, value: value <= high,
    StringStartsWith: lambda head, value: value.startswith(head),
}
