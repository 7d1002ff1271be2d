"""Landed JSON payloads (member lists, collections) as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import schema


def list_members(pages: DataFrame, payload: str = "payload", list_name: str = "list_name") -> DataFrame:
    """One row per member of every landed list page: list, id, screen name, name."""
    users = F.explode(F.from_json(payload, schema.MEMBER_PAGE)["users"]).alias("member")
    return pages.select(list_name, users).select(list_name, "member.id", "member.screen_name", "member.name")


def collection_ids(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """Post ids of landed collection pages; a page without posts gives no rows."""
    objects = F.from_json(payload, schema.COLLECTION_PAGE)["objects"]["tweets"]
    return pages.select(F.explode(F.map_keys(objects)).alias("key")).select(F.col("key").cast("bigint").alias("id"))


def member_page(*members: Column) -> Column:
    """Export form of a member page."""
    return F.to_json(F.struct(F.array(*members).alias("users")))


def id_batches(df: DataFrame, group: str, position: str, id_col: str = "id", size: int = 100) -> DataFrame:
    """Ids as comma-joined batches in position order.

    A request carries a bounded number of ids, so a group is cut by position: a batch
    never holds more than ``size`` positions, however large its group.
    """
    batch = F.floor(F.col(position) / size).cast("bigint")
    ordered = F.sort_array(F.collect_list(F.struct(position, id_col)))
    return (
        df.groupBy(group, batch.alias("batch"))
        .agg(ordered.alias("members"))
        .select(group, "batch", F.array_join(F.transform("members", lambda m: m[id_col].cast("string")), ",").alias("ids"))
    )


def members_of(members: DataFrame, list_name: str) -> DataFrame:
    """User ids of the named list; a name nobody is listed under is an error."""
    found = members.where(F.col("list_name") == list_name).select("user_id")
    if found.isEmpty():
        raise ValueError(f"no list named {list_name!r}")
    return found


def id_of_name(directory: DataFrame, name: str) -> str:
    """The id a named list or collection has; an unknown name is an error."""
    row = directory.where(F.col("name") == name).select("id").first()
    if row is None:
        raise ValueError(f"nothing named {name!r}")
    return row["id"]
