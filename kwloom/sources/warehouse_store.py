"""The warehouse as versioned tables: loads are merged copy on write, and a version is there when its commit file is.

    commits/00000007      one JSON object: for each table the folder that holds its rows, and the load's counters
    tables/<name>/<id>    Parquet, written once and never changed

A load reads the tables of the last commit, merges the new rows, writes each changed table to a folder of its own and then creates the next
commit. Creating it fails if another load has taken its number, and until then readers see the version before. So a table can be merged from
itself, a load that fails or is interrupted leaves the old version, and folders that no kept commit names are what `vacuum` deletes.

Cases: a file that was loaded with the same hash is skipped unless asked for; a load of nothing commits nothing; rows without a community_id and
terms without a letter are counted but not merged; of rows that repeat within a load the last by `seq` stays; a load that raises is logged as
failed in a version of its own that changes no other table; a dry run writes nothing and returns what a load would.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import warehouse
from .storage import Store

COMMUNITIES = (
    "community_id string, name string, url string, full_url string, rank long, subscribers_count long, displayed_count string, description string, icon_url string, "
    "source_page int, source_path string, first_seen_at string, last_seen_at string, last_scraped_at string, version long"
)
KEYWORDS = "id long, term string"
LINKS = "community_id string, keyword_id long, rank int, score double, weight double, source string, version long"
INGESTS = "id long, input_file string, file_type string, file_hash string, record_count long, processed_at string, status string, error string"
SCHEMAS = {"communities": COMMUNITIES, "keywords": KEYWORDS, "links": LINKS, "ingests": INGESTS}


class Conflict(RuntimeError):
    """Another load has committed first; load again."""


@dataclass
class Load:
    """What a load did, or would do: the version, rows of each table, files taken and files skipped."""

    version: int
    rows: dict[str, int] = field(default_factory=dict)
    files: int = 0
    skipped: int = 0


class Warehouse:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.store = spark, Store(spark, path)

    # --- versions ------------------------------------------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n) for n in self.store.names("commits") if n.isdigit()]

    def commit_of(self, version: int | None = None) -> dict:
        """The commit of a version, the last by default; before any, one of empty tables."""
        known = self.versions()
        if not known and version in (None, 0):
            return {"version": 0, "tables": {}, "rows": {}}
        return json.loads(self.store.read(f"commits/{known[-1] if version is None else version:08d}"))

    def table(self, name: str, version: int | None = None) -> DataFrame:
        return self._read(name, self.commit_of(version))

    def _read(self, name: str, commit: dict) -> DataFrame:
        folder = commit["tables"].get(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.store.at(folder)) if folder else self.spark.createDataFrame([], SCHEMAS[name])

    def _write(self, name: str, table: DataFrame, number: int) -> tuple[str, DataFrame]:
        """The folder that now holds the table's rows, and the rows as read from it."""
        folder = f"tables/{name}/{number:08d}-{uuid.uuid4().hex}"
        table.select([f.strip().split(" ")[0] for f in SCHEMAS[name].split(",")]).write.parquet(self.store.at(folder))
        return folder, self.spark.read.schema(SCHEMAS[name]).parquet(self.store.at(folder))

    def _committed(self, before: dict, changed: dict[str, DataFrame], dry_run: bool, written: dict[str, str] | None = None, **counters: int) -> Load:
        """Write the changed tables (but those written already) and commit; a dry run counts only."""
        number, folders, rows = before["version"] + 1, dict(written or {}), {}
        for name, table in changed.items():
            if name not in folders and not dry_run:
                folders[name], table = self._write(name, table, number)
            rows[name] = table.count()
        if not dry_run:
            commit = {"version": number, "tables": before["tables"] | folders, "rows": before["rows"] | rows, **counters}
            if not self.store.create(f"commits/{number:08d}", json.dumps(commit)):
                raise Conflict(f"version {number} is taken")
        return Load(number, before["rows"] | rows, counters.get("files", 0), counters.get("skipped", 0))

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete commits but the last `keep`, and folders of tables that no kept commit names; the folders' names."""
        kept = self.versions()[-keep:]
        used = {folder for v in kept for folder in self.commit_of(v)["tables"].values()}
        gone = [f"tables/{t}/{f}" for t in self.store.names("tables") for f in self.store.names(f"tables/{t}") if f"tables/{t}/{f}" not in used]
        for v in self.versions():
            if v not in kept:
                self.store.delete(f"commits/{v:08d}")
        for folder in gone:
            self.store.delete(folder)
        return gone

    # --- loads ---------------------------------------------------------------------------------------------------------------

    def load_keywords(self, lists: DataFrame, files: DataFrame, now: str, skip_unchanged: bool = True, rebuild: bool = False, dry_run: bool = False) -> Load:
        """Merge keyword lists.

        lists(input_file, seq, community_id, name, rank, subscribers_count, url, keywords: array of struct(term, weight, score, source)) with further columns of
        `communities` where known; files(input_file, file_hash[, error]): the files that the lists come from. A file with an error is logged only.
        """
        before = {"version": self.versions()[-1] if self.versions() else 0, "tables": {}, "rows": {}} if rebuild else self.commit_of()
        number, log = before["version"] + 1, self._read("ingests", before)
        taken, skipped, good = self._taken(files, log, "keywords", skip_unchanged)
        if not taken.take(1):
            return Load(before["version"], before["rows"], 0, skipped)
        try:
            rows = lists.join(good.select("input_file"), "input_file", "left_semi")
            named = rows.filter(F.coalesce("community_id", F.lit("")) != "")
            links = named.select("community_id", "seq", F.posexplode("keywords").alias("at", "k"))
            links = links.select("community_id", "seq", (F.col("at") + 1).alias("rank"), F.trim("k.term").alias("term"), *[F.coalesce(f"k.{c}", F.lit(0.0)).alias(c) for c in ("weight", "score")], F.coalesce(F.nullif(F.col("k.source"), F.lit("")), F.lit("unknown")).alias("source"))
            links = links.filter(F.coalesce("term", F.lit("")) != "")
            words, written = warehouse.extend_dictionary(self._read("keywords", before), links.select("term")), {}
            if not dry_run:
                written["keywords"], words = self._write("keywords", words, number)
            # of a term that a list holds twice the later place counts
            order = lambda s, r: F.struct(s.cast("long").alias("s"), r.cast("long").alias("r")).alias("seq")
            new = links.join(words.withColumnRenamed("id", "keyword_id"), "term")
            new = new.select("community_id", "keyword_id", "rank", "score", "weight", "source", F.lit(number).cast("long").alias("version"), order(F.col("seq"), F.col("rank")))
            old = self._read("links", before).withColumn("seq", order(F.lit(-1), F.lit(0)))
            changed = {"communities": self._communities(before, named, number, now), "keywords": words, "links": warehouse.upsert_links(old, new).drop("seq"), "ingests": self._logged(log, taken, rows, "keywords", now)}
            return self._committed(before, changed, dry_run, written, files=taken.count(), skipped=skipped)
        except Conflict:
            raise
        except Exception as e:
            self._failed(taken, "keywords", now, f"{type(e).__name__}: {e}", dry_run)
            raise

    def load_pages(self, pages: DataFrame, files: DataFrame, now: str, skip_unchanged: bool = True, dry_run: bool = False) -> Load:
        """Merge listing pages straight into the communities: pages(input_file, seq, community_id, ...), files as for keyword lists. Links stay as they are."""
        before = self.commit_of()
        log = self._read("ingests", before)
        taken, skipped, good = self._taken(files, log, "pages", skip_unchanged)
        if not taken.take(1):
            return Load(before["version"], before["rows"], 0, skipped)
        try:
            rows = pages.join(good.select("input_file"), "input_file", "left_semi")
            named = rows.filter(F.coalesce("community_id", F.lit("")) != "")
            changed = {"communities": self._communities(before, named, before["version"] + 1, now), "ingests": self._logged(log, taken, rows, "pages", now)}
            return self._committed(before, changed, dry_run, files=taken.count(), skipped=skipped)
        except Conflict:
            raise
        except Exception as e:
            self._failed(taken, "pages", now, f"{type(e).__name__}: {e}", dry_run)
            raise

    def _failed(self, taken: DataFrame, kind: str, now: str, error: str, dry_run: bool) -> None:
        """Log that a load failed; the other tables stay those of the version before."""
        if not dry_run:
            before = self.commit_of()
            log = self._read("ingests", before)
            bad = taken.select("input_file", "file_hash", F.lit(error[:2000]).alias("error"))
            self._committed(before, {"ingests": self._logged(log, bad, None, kind, now)}, False)

    def _taken(self, files: DataFrame, log: DataFrame, kind: str, skip_unchanged: bool) -> tuple[DataFrame, int, DataFrame]:
        """The files to load, how many are skipped, and those of the first without an error."""
        every = files if "error" in files.columns else files.withColumn("error", F.lit(None).cast("string"))
        taken = warehouse.changed_files(every, log.filter(F.col("file_type") == kind)) if skip_unchanged else every
        return taken, every.count() - taken.count(), taken.filter(F.coalesce("error", F.lit("")) == "")

    def _communities(self, before: dict, rows: DataFrame, number: int, now: str) -> DataFrame:
        """The communities with those of rows(community_id, seq, ...) merged in; columns that rows doesn't have stay as they are."""
        old = self._read("communities", before)
        own = [f.strip().split(" ")[0] for f in COMMUNITIES.split(",")]
        have = [c for c in own if c in rows.columns and c in warehouse.OVERWRITTEN + warehouse.NON_EMPTY]
        scraped = F.col("scraped_at") if "scraped_at" in rows.columns else F.lit(now)
        new = rows.select("community_id", *have, F.lit(now).alias("seen_at"), scraped.alias("scraped_at"), (F.col("seq").cast("long") + 1).alias("seq"))
        known = old.select("community_id", *have, F.col("last_seen_at").alias("seen_at"), F.col("last_scraped_at").alias("scraped_at"), F.lit(0).cast("long").alias("seq"))
        up = warehouse.upsert_communities(known, new)
        rest = [c for c in own if c not in up.columns and c != "version"]
        stay = old.select("community_id", *rest, F.col("first_seen_at").alias("_first"), F.col("version").alias("_was"))
        up = up.join(stay, "community_id", "left").join(new.select("community_id", F.lit(True).alias("_new")).distinct(), "community_id", "left")
        return up.withColumn("first_seen_at", F.coalesce("_first", "first_seen_at")).withColumn("version", F.when(F.col("_new"), F.lit(number).cast("long")).otherwise(F.col("_was"))).select(own)

    def _logged(self, log: DataFrame, taken: DataFrame, rows: DataFrame | None, kind: str, now: str) -> DataFrame:
        new = warehouse.log_rows(taken.select("input_file", "file_hash", F.lit(now).alias("processed_at"), "error"), log)
        counts = rows.groupBy("input_file").agg(F.count("*").alias("record_count")) if rows is not None else taken.select("input_file", F.lit(0).alias("record_count"))
        new = new.join(counts, "input_file", "left").select("id", "input_file", F.lit(kind).alias("file_type"), "file_hash", F.coalesce("record_count", F.lit(0)).cast("long").alias("record_count"), "processed_at", "status", "error")
        return log.unionByName(new)
