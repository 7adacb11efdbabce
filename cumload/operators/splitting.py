"""Projects that may be one, split in parts: groups of a family, near each other and within a window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cumload.operators.resolve import _cut, anchored_windows, lowest_labels


def near_pairs(members: DataFrame, places: DataFrame, adjacency: DataFrame) -> DataFrame:
    """Pairs a_id < b_id of one family and window with a shared or neighbouring place.

    ``members``: family, window, id; ``places``: id, place; ``adjacency``: place, other (one direction is enough). All
    joins are on equal keys: each project is put under its places and their neighbours.
    """
    both = adjacency.select("place", "other").union(adjacency.select("other", "place")).distinct()
    at = members.join(places, "id")
    around = at.join(both, "place").select("family", "window", "id", F.col("other").alias("place")).unionByName(at.select("family", "window", "id", "place"))
    a, b = at.select("family", "window", "place", F.col("id").alias("a_id")), around.select("family", "window", "place", F.col("id").alias("b_id")).distinct()
    pair = a.join(b, ["family", "window", "place"]).where("a_id <> b_id")
    return pair.select("family", "window", F.least("a_id", "b_id").alias("a_id"), F.greatest("a_id", "b_id").alias("b_id")).distinct()


def family_groups(projects: DataFrame, families: DataFrame, places: DataFrame, adjacency: DataFrame, limit: float = 50.0, assessed: DataFrame | None = None) -> DataFrame:
    """(family, project_ids, mw_total, first_seen, last_seen) of groups whose parts lie below ``limit`` and whose sum exceeds it.

    ``projects``: id, mw_best, first_seen; ``families``: id, family (several for joint ventures). Windows come first,
    so links cannot chain a group beyond one; a set of projects is reported once, under its first family. Projects that
    are ``assessed`` (id) as a whole are in no group (F12).
    """
    small = projects.where((F.col("mw_best") > 0) & (F.col("mw_best") < limit))
    small = small if assessed is None else small.join(assessed, "id", "left_anti")
    held = small.join(families, "id").select("family", "id", F.col("first_seen").alias("day"))
    members = _cut(anchored_windows(held, "family"))
    pairs = near_pairs(members, places, adjacency)
    # a node is a project in a family and window
    node = lambda c: F.struct("family", "window", F.col(c).alias("id"))
    labels = lowest_labels(_cut(pairs.select(node("a_id").alias("a_id"), node("b_id").alias("b_id"))))
    sums = labels.select("component", "id.family", "id.id").join(small.select("id", "mw_best", "first_seen"), "id").groupBy("component", "family").agg(F.array_sort(F.collect_list("id")).alias("project_ids"), F.round(F.sum("mw_best"), 4).alias("mw_total"), F.min("first_seen").alias("first_seen"), F.max("first_seen").alias("last_seen"))
    return sums.where(F.col("mw_total") > limit).groupBy("project_ids").agg(F.min("family").alias("family"), F.first("mw_total").alias("mw_total"), F.first("first_seen").alias("first_seen"), F.first("last_seen").alias("last_seen"))
