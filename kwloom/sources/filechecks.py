"""Checks of output files by their metadata and their first bytes, and where a run can go on.

Sizes and times come from the file listing. Only files that pass by these are opened, and of each only its first HEAD bytes are read, in tasks
over the listing, so a folder of large files costs a small read a file.

Cases: an empty file is "empty", one without an object in its first lines "broken", one older than its input "stale", else "valid"; one that can't
be opened is "unreadable"; an output whose input isn't there is judged without it; a folder without files has no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, LINES = 65_536, 1_000


def _opened(path: str, size: int) -> bytes | None:
    """The first bytes of a file that pyarrow's file systems reach (local, HDFS, S3, GCS); None if it can't be read."""
    from urllib.parse import unquote

    from pyarrow import fs

    try:
        files, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), unquote(path.removeprefix("file:")))
        with files.open_input_stream(at) as f:
            return f.read(size)
    except (OSError, pa.ArrowInvalid):
        return None


def heads(files: DataFrame, size: int = HEAD) -> DataFrame:
    """(path, head): the first bytes of each file of files(path); null where it can't be read."""

    def read(batches):
        for b in batches:
            paths = b.column("path").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array([_opened(p, size) for p in paths], pa.binary())], ["path", "head"])

    return files.select("path").mapInArrow(read, "path string, head binary")


def has_object(head: Column, lines: int = LINES) -> Column:
    """Whether one of the first lines that aren't blank could begin a JSON object."""
    return F.exists(F.slice(F.split(F.decode(head, "UTF-8"), "\n"), 1, lines), lambda x: x.contains("{"))


def verified(files: DataFrame, inputs: DataFrame | None = None, size: int = HEAD) -> DataFrame:
    """(path, length, modified, state) of files(path, length, modified, name); inputs(name, modified): what each is made from."""
    out = files.join(inputs.select("name", F.col("modified").alias("_since")), "name", "left") if inputs is not None else files.withColumn("_since", F.lit(None).cast("timestamp"))
    stale = F.coalesce(F.col("_since") > F.col("modified"), F.lit(False))
    out = out.withColumn("state", F.when(F.col("length") <= 0, "empty").when(stale, "stale"))
    looked = heads(out.filter("state is null"), size)
    out = out.join(looked, "path", "left")
    return out.select("path", "length", "modified", F.coalesce("state", F.when(F.col("head").isNull(), "unreadable").when(has_object(F.col("head")), "valid").otherwise("broken")).alias("state"))


def directory_report(states: DataFrame) -> DataFrame:
    """One row: files by state, bytes, and the newest file's time; states as `verified` gives them."""
    n = lambda s: F.count_if(F.col("state") == s).alias(s)
    return states.agg(F.count("*").alias("files"), *[n(s) for s in ("valid", "empty", "broken", "stale", "unreadable")], F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.max("modified").alias("newest"))


def progress(files: DataFrame) -> DataFrame:
    """(path, name, last_page, complete) of files that tell how far a run got: <any>_progress_page_<n>.json, page_<n>.json and <any>_complete.json."""
    stem = F.regexp_replace("name", r"\.json$", "")
    page = F.coalesce(F.nullif(F.regexp_extract(stem, r"^(?:.*_progress_)?page_([0-9]+)$", 1), F.lit("")).try_cast("int"), F.lit(0))
    done = stem.rlike("_complete$")
    return files.filter(done | (page > 0)).select("path", "name", page.alias("last_page"), done.alias("complete"))


def resume_from(progressed: DataFrame, complete_pages: DataFrame | None = None) -> DataFrame:
    """One row: the file that got furthest and the page to go on from, 1 without any; complete_pages(path, last_page): what complete files hold. Of equals the complete one."""
    p = progressed
    if complete_pages is not None:
        p = p.join(complete_pages.select("path", F.col("last_page").alias("_own")), "path", "left").withColumn("last_page", F.coalesce("_own", "last_page")).drop("_own")
    best = p.agg(F.max(F.struct("last_page", "complete", F.col("path").alias("path"))).alias("b"))
    return best.select(F.col("b.path").alias("path"), F.coalesce("b.last_page", F.lit(0)).alias("last_page"), (F.coalesce("b.last_page", F.lit(0)) + 1).alias("next_page"))
