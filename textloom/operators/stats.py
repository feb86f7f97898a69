"""URL statistics: protocols and domains of pages, counted with partial aggregation; only ``url`` is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import domain, has_url, protocol

TOP, MANY = 100, 1_000_000


def url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """(protocol, domain) of pages whose URL has a host. The filter on the URL itself reaches the scan."""
    u = F.col(url)
    return pages.where(has_url(u)).select(protocol(u).alias("protocol"), domain(u).alias("domain")).where(F.coalesce(F.col("domain"), F.lit("")) != "")


def protocol_counts(pages: DataFrame, url: str = "url") -> DataFrame:
    """(protocol, n, pct): pct of valid URLs. The total comes from the few counted rows (a protocol each), not from another scan."""
    n = url_parts(pages, url).groupBy("protocol").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return n.select("protocol", "n", F.round(F.col("n") * 100.0 / total, 2).alias("pct"))


def domain_counts(pages: DataFrame, min_frequency: int = 1, url: str = "url", prune_many: bool = False) -> DataFrame:
    """(domain, n) with n at least ``min_frequency``. ``prune_many``: beyond a million domains those seen once go, whatever the threshold."""
    n = url_parts(pages, url).groupBy("domain").agg(F.count("*").alias("n"))
    if prune_many:
        many = n.agg(F.count("*") > MANY).scalar()
        n = n.where(~many | (F.col("n") >= max(2, min_frequency)))
    return n.where(F.col("n") >= min_frequency) if min_frequency > 1 else n


def top_domains(pages: DataFrame, k: int = TOP, url: str = "url") -> DataFrame:
    """The ``k`` most frequent domains, ties by name: a top-k of each partition, then of those."""
    return domain_counts(pages, url=url).orderBy(F.desc("n"), "domain").limit(k)


def top_shares(pages: DataFrame, k: int = 20, url: str = "url") -> DataFrame:
    """(domain, n, pct of all valid URLs) of the ``k`` most frequent domains."""
    n = domain_counts(pages, url=url)
    total = n.agg(F.sum("n")).scalar()
    best = n.orderBy(F.desc("n"), "domain").limit(k)
    return best.select("domain", "n", F.round(F.col("n") * 100.0 / total, 2).alias("pct"))


def url_summary(pages: DataFrame, min_frequency: int = 2, url: str = "url") -> DataFrame:
    """One row of totals from a single scan: pages are counted by domain, the row without a domain holds the rest.

    A table without the URL column counts in total only.
    """
    k = F.lit(min_frequency).cast("long").alias("min_frequency_threshold")
    if url not in pages.columns:
        zero = [F.lit(0).cast("long").alias(c) for c in ("valid_urls", "invalid_urls", "unique_domains_total", "unique_domains_filtered")]
        return pages.agg(F.count("*").alias("total_records")).select("total_records", *zero, k)
    d = F.nullif(domain(F.col(url)), F.lit("")).alias("domain")
    n = pages.select(d).groupBy("domain").agg(F.count("*").alias("n"))
    known = F.col("domain").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return n.agg(
        total(F.col("n")).alias("total_records"),
        total(F.when(known, F.col("n"))).alias("valid_urls"),
        total(F.when(~known, F.col("n"))).alias("invalid_urls"),
        F.count_if(known).alias("unique_domains_total"),
        F.count_if(known & (F.col("n") >= min_frequency)).alias("unique_domains_filtered"),
    ).select("*", k)


def report(pages: DataFrame, min_frequency: int = 2, k: int = TOP, url: str = "url") -> dict:
    """The statistics report: totals, protocols and the ``k`` most frequent domains. Small whatever the input; all domains above the
    threshold are a table of their own (``domain_counts``), written as such."""
    summary = url_summary(pages, min_frequency, url).first().asDict()
    protocols = {r.protocol: r.n for r in protocol_counts(pages, url).orderBy(F.desc("n"), "protocol").collect()}
    return {"summary": summary, "protocol_distribution": protocols, "domain_distribution": {r.domain: r.n for r in top_domains(pages, k, url).collect()}}
