"""Counters and manifests of runs, gathered in the pass that writes the rows.

`written` observes its counters while the rows go to their files (DataFrame.observe), so nothing is read a second time to count it. Manifests
are small reports made of such counters and of file listings.

Cases: a run without rows has counters of 0 or null; a retried task's rows count once, as Spark takes the last attempt's; a page without an
error text is done; names that are no page files are left out of manifests.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .storage import Store


def written(rows: DataFrame, path: str, counters: dict[str, Column], mode: str = "errorifexists", kind: str = "parquet", partition: list[str] | None = None) -> dict:
    """Write rows and return what the counters (aggregates by name) are over them, of the same pass."""
    seen = Observation()
    out = rows.observe(seen, *[c.alias(name) for name, c in counters.items()]).write.format(kind).mode(mode)
    (out.partitionBy(*partition) if partition else out).save(path)
    return seen.get


def page_counters() -> dict[str, Column]:
    """Counters of a scraping run over pages(page, error, subreddits): pages, failed ones, communities and the last page."""
    bad = F.coalesce("error", F.lit("")) != ""
    communities = F.coalesce(F.size("subreddits"), F.lit(0))
    return {
        "pages": F.count(F.lit(1)), "failed": F.count_if(bad), "communities": F.coalesce(F.sum(F.greatest(communities, F.lit(0))), F.lit(0)),
        "first_page": F.min("page"), "last_page": F.max("page"), "empty": F.count_if(~bad & (communities <= 0)),
    }


def write_pages(pages: DataFrame, root: str, now: datetime) -> dict:
    """Write pages under root/pages and the run's manifest as root/manifest.json (replaced if it is there); returns the manifest.

    The pages done are a list in the manifest, as runs resume from it: a number a page, gathered by their own pass over the written files' one column.
    """
    spark = pages.sparkSession
    counts = written(pages, f"{root}/pages", page_counters(), "append", "json")
    done = spark.read.schema("page int, error string").json(f"{root}/pages").filter("coalesce(error, '') = '' and page is not null").select("page").distinct()
    manifest = {"last_page": counts["last_page"], "pages_done": sorted(r.page for r in done.toLocalIterator()), "total": counts["communities"], "failed": counts["failed"], "updated_at": now.isoformat(), "week_id": now.strftime("%G-W%V"), "format": "per-page"}
    store = Store(spark, root)
    store.delete("manifest.json")
    store.create("manifest.json", json.dumps(manifest))
    return manifest


def file_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, folder, length, modified) of the files under a folder; contents are not read. Empty files are listed too, without a time: a scan leaves them out."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:///") if "://" not in path or path.startswith("file:") else c
    scanned = found.select(plain(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified"))
    every = spark.createDataFrame([(p,) for p in found.inputFiles()], "path string").select(plain(F.url_decode("path")).alias("path"))
    files = every.join(scanned, "path", "left").withColumn("length", F.coalesce("length", F.lit(0)))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder"), "length", "modified")


def post_manifests(files: DataFrame) -> DataFrame:
    """(community, post_files, count) of post files <community>/posts/<name>.json: what each community has, names sorted; files(path) as file_listing gives them."""
    place = F.regexp_extract("path", r"/([^/]+)/posts/([^/]+\.json)$", 1).alias("community"), F.regexp_extract("path", r"/([^/]+)/posts/([^/]+\.json)$", 2).alias("name")
    per = files.select(*place).filter("community <> ''").groupBy("community").agg(F.array_sort(F.collect_set("name")).alias("post_files"))
    return per.withColumn("count", F.size("post_files"))


def page_metadata(pages: DataFrame) -> DataFrame:
    """One row a community_id of pages' communities (page, community_id, ...): what a keyword list is filled up with; of repeats the last by page, then place."""
    own = [c for c in pages.columns if c != "community_id"]
    return pages.filter("coalesce(community_id, '') <> ''").groupBy("community_id").agg(F.max_by(F.struct(*own), F.struct("page", "seq")).alias("m")).select("community_id", "m.*")
