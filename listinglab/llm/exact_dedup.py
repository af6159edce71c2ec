"""Operator 4: exact deduplication, in DataFrame functions only.

Documents are grouped by a 128-bit content hash; the bytes inside every group
of more than one are then compared, so that a collision of hashes never joins
different texts. Two texts are equal when they are identical after
lower-casing A-Z.

Plan. One scan writes (id, hash, sha256) of every row: small rows, whatever
the texts' length. Group counts come from these, with a map-side combine, so a
group with a third of all rows is a handful of partial rows. A second scan
takes the texts of groups of two and more and groups them by (hash, text):
this is the comparison of bytes, again combined before the shuffle, and no
group is ever gathered. The answer joins the small rows with one row per
group; both sides are written tables, so Spark broadcasts the groups when
their files are small and otherwise splits a hot group as a skewed join.

Edge cases. A null text counts as empty, and empty texts form one group. A row
with a null id takes part as a copy, but stays only if no row of its group
has an id. Repeated rows (same id and text) are counted in ``group_size`` and
share one answer; ``drop_copies`` leaves one of them. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listinglab.llm.common import ascii_lower, packed, save, unpacked


def md5_128(norm: Column) -> Column:
    """The 128-bit content hash."""
    return F.unhex(F.md5(norm))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                 content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` says which stable id of a group stays, the smallest or the largest.
    """
    best = {"smallest": F.min, "largest": F.max}[keep]
    norm = ascii_lower(F.col(text_col))
    source = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"))
    hashed = source.select("doc_id", "norm", content_hash(F.col("norm")).alias("h"))
    rows = save(hashed.select("doc_id", "h", F.sha2("norm", 256).alias("text_sha256")), "exact-rows")

    multi = save(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "exact-multi")
    classes = save(
        hashed.join(multi, "h", "left_semi").groupBy("h", "norm")
        .agg(F.count(F.lit(1)).alias("size"), best("doc_id").alias("best")), "exact-classes")
    # Hashes that stand for more than one text: empty but for a collision.
    clash = save(classes.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("h"), "exact-clash")

    clean = classes.join(clash, "h", "left_anti").select("h", "size", "best")
    answers = rows.join(clean, "h", "left")
    if not clash.isEmpty():
        own = hashed.join(clash, "h", "left_semi").withColumn("text_sha256", F.sha2("norm", 256))
        answers = answers.join(clash, "h", "left_anti").select("h", "doc_id", "text_sha256", "size", "best").unionByName(
            own.join(classes, ["h", "norm"]).select("h", "doc_id", "text_sha256", "size", "best"))
    stays = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("best"))
    return answers.select(
        "doc_id", stays.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(stays).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The documents without exact copies; whole rows, all columns."""
    columns = docs.columns
    kept = exact_groups(docs, id_col, text_col, keep).where("kept").select("doc_id", "text_sha256").distinct()
    whole = packed(docs, id_col, F.sha2(ascii_lower(F.col(text_col)), 256))
    rows = whole.join(kept, whole["key"].eqNullSafe(kept["doc_id"]) & (whole["tag"] == kept["text_sha256"]), "left_semi")
    return unpacked(rows.dropDuplicates(["key", "tag"]), columns)
