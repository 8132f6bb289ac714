"""WARC records and a Merkle fixity audit of two replicas.

Each page is a WARC record. Records are dealt into files by a hash, and each replica orders a
file by itself and adds up its own sizes, which fixes the offset range of every record there.
Leaves are the records' SHA-256 digests; a node of the tree is the digest of its (at most
``FAN_OUT``) children in the original's order, each with its offset range counted from the
start of the node. So a record of another length changes its own nodes and not all that follow
it. Above the files the tree goes on to one root. The replicas' roots are compared, and only
children of nodes that differ are looked at, down to the records.

Only digests are shuffled, never records. Every level is a sixteenth of the one below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellwise.session import durable, sized

FAN_OUT = 16
FILE_RECORDS = 2_000
# The digest of a record that is not there, as long as others so that no two lists of children
# join to the same bytes.
MISSING = bytes(32)

_RANGES = ["first", "last", "copy_first", "copy_last"]


def record(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC/1.1 response record in bytes; null parts are empty."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )
    return head.cast("binary")


def leaves(records: DataFrame, record_id: str, original: str, copy: str, place: str | None = None, copy_place: str | None = None) -> DataFrame:
    """(node, id, first, last, copy_first, copy_last, a, b): records in the original's order, with
    the offset ranges and digests that either replica gives them.

    A missing (null) original or copy has the digest MISSING and no bytes. Files take about
    FILE_RECORDS records each; ``node`` numbers file by file. ``place`` and ``copy_place`` are
    the columns that order each replica, the id if not given.
    """
    columns = [F.col(record_id).alias("id"), F.col(place or record_id).alias("place"), F.col(copy_place or record_id).alias("copy_place")]
    for c, digest, size in ((original, "a", "size"), (copy, "b", "copy_size")):
        columns.append(F.coalesce(F.unhex(F.sha2(F.col(c), 256)), F.lit(MISSING)).alias(digest))
        columns.append(F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint").alias(size))
    # Equal rows keep one order in both replicas.
    hashed = durable(records.select(*columns, F.monotonically_increasing_id().alias("row")))
    files = hashed.count() // FILE_RECORDS + 1
    hashed = hashed.withColumn("file", F.pmod(F.xxhash64("id", "a"), F.lit(files)))
    order = Window.partitionBy("file").orderBy("place", "id", "row")
    copy_order = Window.partitionBy("file").orderBy("copy_place", "id", "row")
    last = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    copy_last = F.sum("copy_size").over(copy_order.rowsBetween(Window.unboundedPreceding, 0))
    placed = hashed.select("id", "a", "b", "file", "size", "copy_size", (F.row_number().over(order) - 1).alias("own"), last.alias("last"), copy_last.alias("copy_last"))
    placed = durable(placed)
    most = placed.agg(F.max("own")).head()[0] or 0
    width = 1
    while width <= most:
        width *= FAN_OUT
    node = (F.col("file") * width + F.col("own")).cast("bigint").alias("node")
    first, copy_first = (F.col("last") - F.col("size")).alias("first"), (F.col("copy_last") - F.col("copy_size")).alias("copy_first")
    return placed.select(node, "id", first, "last", copy_first, "copy_last", "a", "b")


def tree(level: DataFrame) -> list[DataFrame]:
    """Levels of the tree from the leaves to the root, each written durably."""
    levels = [durable(level)]
    while (levels[-1].agg(F.max("node")).head()[0] or 0) > 0:
        children = F.array_sort(F.collect_list(F.struct("node", *_RANGES, "a", "b")))
        spans = [(F.min if c.endswith("first") else F.max)(c).alias(c) for c in _RANGES]
        joined = levels[-1].groupBy(F.floor(F.col("node") / FAN_OUT).alias("node")).agg(children.alias("c"), *spans)
        levels.append(durable(joined.select("node", *_RANGES, _digest("a", "first", "last"), _digest("b", "copy_first", "copy_last"))))
    return levels



def _digest(side: str, first: str, last: str) -> Column:
    """The digest of the children's digests in order, each with its range in the node."""

    def child(c: Column) -> Column:
        return F.concat_ws(":", F.hex(c[side]), (c[first] - F.col(first)).cast("string"), (c[last] - F.col(first)).cast("string"))

    return F.unhex(F.sha2(F.array_join(F.transform("c", child), ","), 256)).alias(side)


def audit(records: DataFrame, record_id: str, original: str, copy: str, place: str | None = None, copy_place: str | None = None) -> DataFrame:
    """(id, n_bytes, first, last, sha256, status) of every record.

    ``status`` is ``corrupt`` where the copy's bytes differ and ``missing`` where one of the two
    is null; it comes from the descent, not from comparing all leaves. A node that differs though
    none of its children does holds records whose bytes are right and whose order or offsets
    are not: all of these are ``moved``. The rest is ``ok``. ``place`` and ``copy_place`` are as
    for :func:`leaves`. Rows that share an id are records of their own. An empty table has no rows.
    """
    levels = tree(leaves(records, record_id, original, copy, place, copy_place))
    differs = F.col("a") != F.col("b")
    up = F.floor(F.col("node") / FAN_OUT)
    wrong, _ = sized(levels[-1].where(differs).select("node"))
    moved = []
    for height in range(len(levels) - 1, 0, -1):
        below = levels[height - 1].join(wrong.withColumnRenamed("node", "up"), up == F.col("up"), "left_semi")
        found, _ = sized(below.where(differs).select("node"))
        barren, n_barren = sized(wrong.join(found.select(up.alias("node")), "node", "left_anti"))
        if n_barren:
            moved.append((FAN_OUT**height, barren))
        wrong = found
    marked = levels[0].join(wrong.withColumn("bad", F.lit(True)), "node", "left").withColumn("moved", F.lit(False))
    for span, barren in moved:
        under = barren.select(F.col("node").alias("under"))
        marked = marked.join(under, F.floor(F.col("node") / span) == F.col("under"), "left")
        marked = marked.withColumn("moved", F.col("moved") | F.col("under").isNotNull()).drop("under")
    missing = (F.col("a") == F.lit(MISSING)) | (F.col("b") == F.lit(MISSING))
    intact = F.when(F.col("moved"), "moved").otherwise("ok")
    status = F.when(F.col("bad").isNull(), intact).when(missing, "missing").otherwise("corrupt")
    return marked.select("id", (F.col("last") - F.col("first")).alias("n_bytes"), "first", "last", F.lower(F.hex("a")).alias("sha256"), status.alias("status"))
