"""Threads: questions with their answers and comments from flat tables, and the orders used in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import site_page

UNKNOWN = "Unknown"


def vote_sorted(answers: Column) -> Column:
    """Answers (structs with accepted and score): the accepted one first, then by falling score; equal ones stay in their order."""
    placed = F.transform(answers, lambda a, k: F.struct((~F.coalesce(a.accepted, F.lit(False))).alias("later"), (-F.coalesce(a.score, F.lit(0))).alias("low"), k.alias("at"), a.alias("answer")))
    return F.transform(F.sort_array(placed), lambda p: p.answer)


def time_sorted(entries: Column) -> Column:
    """Entries (structs with date and id) by date, then id."""
    placed = F.transform(entries, lambda e: F.struct(e.date.alias("date"), e.id.alias("id"), e.alias("entry")))
    return F.transform(F.sort_array(placed), lambda p: p.entry)


def post_authors(revisions: DataFrame, users: DataFrame, site: str) -> DataFrame:
    """Post and the sorted pages and names of those who revised it. revisions: post_id, user_id; users: id, name. Revisions by nobody known are left out."""
    known = users.filter(F.col("id") != -1).select(F.col("id").alias("user_id"), F.array(site_page(F.lit(site), F.col("id"), "users"), "name").alias("who"))
    wrote = revisions.filter(F.col("user_id").isNotNull() & (F.col("user_id") != -1)).join(known, "user_id")
    return wrote.groupBy("post_id").agg(F.array_distinct(F.sort_array(F.flatten(F.collect_set("who")))).alias("authors"))


def assemble(posts: DataFrame, comments: DataFrame, authors: DataFrame, site: str, by_votes: bool = True, with_comments: bool = True) -> DataFrame:
    """Documents of whole threads.

    posts: id, kind (1 question, 2 answer), parent_id, accepted_id, title, body,
    score, date, license. comments: id, post_id, author, text, date, license.
    authors: post_id, authors. Three shuffles: comments and authors by post,
    answers by question. Answers without a question go; posts without authors
    are by "Unknown".
    """
    said = comments.groupBy("post_id").agg(F.collect_list(F.struct("date", "id", "text", "author", "license")).alias("comments"))
    none = F.array().cast(said.schema["comments"].dataType)
    full = posts.join(authors, posts["id"] == authors["post_id"], "left").drop("post_id").join(said, posts["id"] == said["post_id"], "left").drop("post_id")
    full = full.withColumn("authors", F.coalesce("authors", F.array(F.lit(UNKNOWN)))).withColumn("comments", time_sorted(F.coalesce("comments", none)) if with_comments else none)
    answer = F.struct("date", "id", F.col("body").alias("text"), "score", "license", "authors", "comments")
    answers = full.filter("kind = 2").groupBy(F.col("parent_id").alias("question")).agg(F.collect_list(answer).alias("answers"))
    empty = F.array().cast(answers.schema["answers"].dataType)
    asked = full.filter("kind = 1").join(answers, F.col("id") == F.col("question"), "left").drop("question")
    marked = F.transform(F.coalesce("answers", empty), lambda a: a.withField("accepted", F.coalesce(a.id == F.col("accepted_id"), F.lit(False))))
    ordered = vote_sorted(time_sorted(marked)) if by_votes else time_sorted(marked)
    asked = asked.withColumn("answers", ordered).withColumn("question_text", F.concat_ws("\n", "title", "body"))
    texts = F.concat(F.array("question_text"), F.transform("comments", lambda c: c.text), F.flatten(F.transform("answers", lambda a: F.concat(F.array(a.text), F.transform(a.comments, lambda c: c.text)))))
    people = F.concat("authors", F.transform("comments", lambda c: c.author), F.flatten(F.transform("answers", lambda a: F.concat(a.authors, F.transform(a.comments, lambda c: c.author)))))
    terms = F.concat(F.array("license"), F.transform("comments", lambda c: c.license), F.flatten(F.transform("answers", lambda a: F.concat(F.array(a.license), F.transform(a.comments, lambda c: c.license)))))
    clean = lambda x: F.sort_array(F.array_distinct(F.filter(x, lambda v: v.isNotNull())))
    return asked.select(
        F.col("id").cast("string").alias("id"),
        F.array_join(texts, "\n").alias("text"),
        F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss").alias("created"),
        F.struct(
            F.col("license"), F.lit(site).alias("site"), site_page(F.lit(site), F.col("id")).alias("url"), clean(people).alias("authors"), clean(terms).alias("all_licenses"),
            F.lit("votes" if by_votes else "time").alias("sort"), F.lit(with_comments).alias("include_comments"),
        ).alias("metadata"),
    )
