"""Parts of split archives brought together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.text import group_key, split_base, split_part_number, split_total
from siltstone.session import ship


def group_parts(files: DataFrame, id_column: str = "id", conversation: str = "conversation_id", message: str = "message_id", name: str = "filename") -> DataFrame:
    """(group, conversation, n, expected, complete) for numbered parts and single archives.

    Numbered parts of one folded base name and conversation form a group; a bare
    archive of the same name stays outside, on its own message.  ``expected`` is
    the stated total, else the highest less the lowest part plus one; ``gap``
    tells of a part missing between or before them.
    """
    by = parts(files, id_column, conversation, message, name).groupBy("group").agg(F.min("conversation").alias("conversation"), F.count(F.lit(1)).alias("n"), F.count_distinct("part").alias("parts"), F.min("part").alias("low"), F.max("part").alias("high"), F.max("total").alias("total"))
    expected = F.coalesce("total", F.col("high") - F.col("low") + 1, F.lit(1))
    return by.select("group", "conversation", "n", expected.alias("expected"), (F.coalesce(F.col("high") - F.col("low") + 1 > F.col("parts"), F.lit(False)) | F.coalesce(F.col("low") > 1, F.lit(False))).alias("gap"))


def parts(files: DataFrame, id_column: str = "id", conversation: str = "conversation_id", message: str = "message_id", name: str = "filename") -> DataFrame:
    """(id, conversation, message, name, part, total, group) of every file whose name has one of the forms."""
    ship(files.sparkSession)
    f = files.select(F.col(id_column).alias("id"), F.col(conversation).alias("conversation"), F.col(message).alias("message"), F.col(name).alias("name"))
    f = f.withColumns({"base": split_base(F.col("name")), "part": split_part_number(F.col("name")), "total": split_total(F.col("name"))}).filter("base is not null")
    f = f.withColumn("key", group_key(F.col("base")))
    own = F.when(F.col("part").isNull(), F.concat_ws(":", F.lit("single"), "id"))
    f = f.withColumn("group", F.coalesce(own, F.concat_ws(":", F.lit("set"), F.coalesce("conversation", F.lit(-1)), "key")))
    return f.select("id", "conversation", "message", "name", "part", "total", "group")


def numbered(files: DataFrame, group: str, order: str) -> DataFrame:
    """Parts without numbers, numbered in order of name within their group."""
    return files.withColumn("part_no", F.row_number().over(Window.partitionBy(group).orderBy(order)))
