"""Snapshots of a folder of pages by period, kept as folders that are renamed outward a week at a time.

A snapshot is copied under a name that readers don't look at and renamed when it is whole. A rotation renames the oldest week first, each to the
next older place if that is free, so an interrupted one leaves every week in one place, and doing it again goes on where it stopped.

Cases: a folder without pages is not archived; a snapshot of the same period is replaced, moved outward, or kept beside the new one, whose name
then ends in the time; drafts of interrupted runs are deleted by the next.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

from .storage import Store

DRAFT = ".draft-"


def snapshot_name(now: datetime, granularity: str = "week", weeks: int = 0) -> str:
    at = now + timedelta(weeks=weeks)
    year, week, _ = at.isocalendar()
    return {"day": f"{at:%Y-%m-%d}", "month": f"{at:%Y-%m}", "timestamp": f"{at:%Y%m%d_%H%M%S}"}.get(granularity, f"{year}-W{week:02d}")


def rotate(store: Store, now: datetime, depth: int) -> list[tuple[str, str]]:
    """Rename weeks outward, the oldest of `depth` first and this week last: (old, new) of what was renamed; a week whose place is taken stays."""
    done = []
    for back in range(depth, -1, -1):
        old, new = snapshot_name(now, weeks=-back), snapshot_name(now, weeks=-(back + 1))
        if store.rename(old, new):
            done.append((old, new))
    return done


def archive(spark: SparkSession, pages: str, root: str, now: datetime, granularity: str = "week", overwrite: bool = False, depth: int = 0) -> str | None:
    """Copy the folder of pages (page_*.json) under root and return the snapshot's path; None if there are no pages."""
    source, store = Store(spark, pages), Store(spark, root)
    if not any(n.startswith("page_") and n.endswith(".json") for n in source.names()):
        return None
    for name in store.names():
        if name.startswith(DRAFT):
            store.delete(name)
    name = snapshot_name(now, granularity)
    draft = f"{DRAFT}{name}"
    conf, util = store.fs.getConf(), spark._jvm.org.apache.hadoop.fs.FileUtil
    store.fs.mkdirs(store._path(store.at(draft)))
    util.copy(source.fs, source._path(source.root), store.fs, store._path(store.at(f"{draft}/pages")), False, conf)
    if store.exists(name):
        if granularity != "timestamp" and overwrite:
            store.delete(name)
        elif granularity == "week" and depth > 0:
            rotate(store, now, depth)
        if store.exists(name):
            name = f"{name}_{now:%H%M%S}"
    about = {"snapshot_id": name, "granularity": granularity, "week_id": snapshot_name(now) if granularity == "week" else None, "archived_at": now.isoformat()}
    store.create(f"{draft}/archive_metadata.json", json.dumps(about))
    if not store.rename(draft, name):
        raise RuntimeError(f"snapshot {name} is there already")
    return store.at(name)
