"""Generators: arrays inside payloads become child, bridge and edge rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.operators.windows import dedupe_first

EVENT_MEMBER_LISTS = ["invited", "attending", "declined", "noreply", "maybe"]


def person_entities(payload: DataFrame, kind: str) -> DataFrame:
    """``urls``, ``emails``, ``placesLived`` or ``organizations`` as child rows."""
    fields = [
        "value", "type", "name", "department", "title", "startdate", "enddate", "location",
        "description",
    ]
    return payload.select(F.col("id").alias("parent_id"), F.explode(kind).alias("x")).select(
        "parent_id",
        F.lit("people").alias("parent_type"),
        *[F.col(f"x.{f}").alias(f) for f in fields],
        F.when(F.col("x.primary"), F.lit(True)).alias("is_primary"),
    )


def attachments(payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attachment rows keyed by URL (else id), and the activity bridge."""
    each = (
        payload.select(F.col("id").alias("activities_id"), F.explode("object.attachments").alias("a"))
        .withColumn("attachment_url", F.coalesce("a.url", "a.id"))
        .filter("attachment_url IS NOT NULL")
    )
    images = [
        F.col(f"a.{src}.{part}").alias(f"{src.lower()}_{part}")
        for src in ["image", "fullImage", "embed"]
        for part in ["url", "type", "height", "width"]
    ]
    rows = each.select(
        "activities_id",
        "attachment_url",
        F.col("a.objectType").alias("objecttype"),
        F.col("a.displayName").alias("displayname"),
        F.col("a.content").alias("content"),
        *images,
    )
    rows = dedupe_first(rows, ["attachment_url"], ["activities_id"]).drop("activities_id")
    return rows, each.select("activities_id", "attachment_url").distinct()


def accesses(payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Access rows and the activity bridge."""
    each = payload.select(F.col("id").alias("activities_id"), F.explode("access.items").alias("x"))
    each = each.filter("x.id IS NOT NULL")
    rows = dedupe_first(each.select("activities_id", "x.*"), ["id"], ["activities_id"]).drop("activities_id")
    return rows, each.select("activities_id", F.col("x.id").alias("accesses_id")).distinct()


def _user_dimension(payload: DataFrame, array: str, key: str) -> tuple[DataFrame, DataFrame]:
    each = payload.select(F.col("name").alias("user_name"), F.explode(array).alias("x"))
    dimension = dedupe_first(each.select("user_name", "x.*"), ["id"], ["user_name"]).drop("user_name")
    bridge = each.filter("user_name IS NOT NULL").select("user_name", F.col("x.id").alias(key))
    return dimension, bridge.distinct()


def user_tags(payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _user_dimension(payload, "tag", "tag_id")


def user_edus(payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    return _user_dimension(payload, "edu", "edu_id")


def post_children(payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Comment and like rows of wall posts, each with its parent ``pid``."""
    comments = payload.select(F.col("id").alias("pid"), F.explode("comments.data").alias("x")).select(
        F.col("x.id").alias("id"),
        F.col("x.from.id").alias("from"),
        F.col("x.message").alias("message"),
        F.col("x.created_time").alias("created_time"),
        "pid",
    )
    likes = payload.select(F.col("id").alias("pid"), F.explode("likes.data").alias("x")).select(
        F.col("x.id").alias("uid"), "pid"
    )
    return comments, likes


def edges(payload: DataFrame, as_of: Column, direction: str = "followers") -> DataFrame:
    """``(user, ids[])`` to ``source -> target`` rows.

    Followers point at the user, friends are pointed at by the user; both are
    stored with the queried user as ``source_id``, in separate tables.
    """
    return payload.select(
        F.col("user").alias("source_id"),
        F.explode("ids").alias("target_id"),
        F.lit(direction).alias("direction"),
        as_of.alias("retrieved"),
    )


def reply_ids(payload: DataFrame, array: str = "inReplyTo") -> DataFrame:
    ids = F.filter(F.transform(array, lambda x: x["id"]), lambda x: x.isNotNull())
    return payload.select("id", ids.alias("inreplyto"))


def event_members(payload: DataFrame) -> DataFrame:
    """All of an event's member lists, concatenated in list order."""
    parts = [F.coalesce(F.col(f"{c}.data"), F.array()) for c in EVENT_MEMBER_LISTS]
    return payload.select("id", F.explode(F.concat(*parts)).alias("member")).select("id", "member.*")


def members(payload: DataFrame, kind: str, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """User rows and the group or event bridge (with optional answer status)."""
    if kind == "group":
        each = payload.select("id", F.explode("members.data").alias("m")).select("id", "m.*")
        bridge = each.select(F.col("id").alias("gid"), F.col("uid")).distinct()
    else:
        each = event_members(payload)
        bridge = each.select(
            F.col("uid"), F.col("id").alias("eid"), "rsvp_status", as_of.alias("retrieved")
        ).distinct()
    named = each.select(F.col("id").alias("_owner"), F.col("uid").alias("id"), "name")
    users = dedupe_first(named, ["id"], ["_owner"]).drop("_owner")
    return users, bridge
