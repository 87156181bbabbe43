"""Web archive records and Merkle audits of their replicas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.session import ensure_checkpoint_dir

FILE_BYTES = 64 << 20
RANGE_BYTES = 64 << 10
FANOUT = 16


def record(id: Column, url: Column, body: Column) -> Column:
    """A response record of a web archive; nulls are written as nothing."""
    text = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "),
        F.octet_length(text).cast("string"), F.lit("\r\n\r\n"), text, F.lit("\r\n\r\n"))


def manifest(pages: DataFrame, *, id: str = "page_id", url: str = "url", body: str = "html",
             replica: Column | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Where each record lies: id, file, offset, length, digest, copies (and found).

    Records are dealt to files by their digest, so that no id, host or null fills one file, and
    lie there by id and digest. Rows that repeat a record are stored once, with their number.
    ``replica`` is the body that a second copy holds for the row (null: nothing there); its digest
    is ``found``. Texts of any length go through a hash only; no body is shuffled.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    whole = record(F.col(id), F.col(url), F.col(body))
    held = F.lit(None).cast("string") if replica is None else F.when(
        replica.isNotNull(), F.sha2(record(F.col(id), F.col(url), replica), 256))
    records = pages.select(
        F.col(id).alias("_id"), F.sha2(whole, 256).alias("digest"),
        F.octet_length(whole).cast("long").alias("length"), held.alias("found")).groupBy(
        "_id", "digest", "length", "found").agg(F.count(F.lit(1)).alias("copies")).checkpoint()
    total = records.agg(F.sum("length")).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    number = F.conv(F.substring("digest", 1, 12), 16, 10).cast("long") % F.lit(files)
    before = Window.partitionBy("file").orderBy("_id", "digest", "found").rowsBetween(
        Window.unboundedPreceding, -1)
    return records.withColumn("file", number).withColumn(
        "offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).select(
        F.col("_id").alias(id), "file", "offset", "length", "digest", "copies", "found")


def _nodes(children: DataFrame, address: list, order: str, hashes: list[str]) -> DataFrame:
    """Parents of ordered children: for every column of hashes, a hash over the children's."""
    def over(column: str) -> Column:
        listed = F.sort_array(F.collect_list(F.when(F.col(column).isNotNull(), F.struct(
            F.col(order).alias("_o"), F.col(column).alias("_h")))))
        lines = F.transform(listed, lambda x: F.concat_ws(" ", x["_o"].cast("string"), x["_h"]))
        return F.when(F.count(column) > 0, F.sha2(F.concat_ws("\n", lines), 256)).alias(column)

    return children.groupBy(*address).agg(*[over(column) for column in hashes])


def audit(records: DataFrame, *, id: str = "page_id", expected: str = "digest",
          found: str = "found", range_bytes: int = RANGE_BYTES,
          fanout: int = FANOUT) -> DataFrame:
    """The records in which two replicas differ, found from the roots of their Merkle trees.

    ``records`` lists the records of both: id, file, offset, length and the digest in either (null
    where it has no such record). Leaves are ranges of ``range_bytes`` of a file, hashed over the
    records that begin there in order; every ``fanout`` ranges make a node of the next level, up
    to the file, then files are grouped likewise up to one root. The replicas are compared from
    the root, and only children of nodes that differ are looked at below. A node holds at most
    ``fanout`` children or the records of one range, so no task gathers more.

    Returns id, file, offset, length, expected, found and status (``changed``, ``missing``,
    ``added``). Equal replicas and empty tables give no rows; rows in neither replica are ignored.
    """
    ensure_checkpoint_dir(records.sparkSession)
    both = ["_a", "_b"]
    rows = records.select(
        F.col(id).alias("_id"), "file", "offset", "length", F.col(expected).alias("_a"),
        F.col(found).alias("_b"), F.expr(f"offset div {range_bytes}").alias("range")).checkpoint()
    lines = [F.when(F.col(c).isNotNull(), F.concat_ws(" ", F.col("length").cast("string"), c))
             .alias(c) for c in both]
    level = _nodes(rows.select("file", "range", "offset", *lines), ["file", "range"], "offset",
                   both).checkpoint()
    levels = [level]
    last_range, last_file = level.agg(F.max("range"), F.max("file")).first()
    while (last_range or 0) > 0:
        level = _nodes(level.withColumn("_child", F.col("range")),
                       ["file", F.expr(f"range div {fanout}").alias("range")], "_child", both)
        levels.append(level)
        last_range //= fanout
    over_ranges = len(levels) - 1  # levels whose parent is a longer range of the same file
    while (last_file or 0) > 0:
        level = _nodes(level.withColumn("_child", F.col("file")),
                       [F.expr(f"file div {fanout}").alias("file"), "range"], "_child", both)
        levels.append(level)
        last_file //= fanout

    differs = ~F.col("_a").eqNullSafe(F.col("_b"))
    frontier = levels[-1].filter(differs)
    for place in range(len(levels) - 2, -1, -1):
        parents = frontier.select(F.col("file").alias("_file"), F.col("range").alias("_range"))
        by_range = place < over_ranges
        child_file = F.col("file") if by_range else F.expr(f"file div {fanout}")
        child_range = F.expr(f"range div {fanout}") if by_range else F.col("range")
        frontier = levels[place].join(
            parents, (child_file == F.col("_file")) & (child_range == F.col("_range")),
            "left_semi").filter(differs)
    ranges_hit = frontier.select(F.col("file").alias("_file"), F.col("range").alias("_range"))
    hit = rows.join(ranges_hit, (F.col("file") == F.col("_file"))
                    & (F.col("range") == F.col("_range")), "left_semi").filter(differs)
    status = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "added").otherwise(
        "changed")
    return hit.select(F.col("_id").alias(id), "file", "offset", "length",
                      F.col("_a").alias("expected"), F.col("_b").alias("found"),
                      status.alias("status"))
