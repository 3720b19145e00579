"""WARC records and a Merkle fixity audit of two replicas.

Pages are serialised as WARC/1.1 response records in key order; a manifest holds each record's place in the archive
(position, byte offset, length) and digest. A tree stands over a replica's records in the order of the manifest: a leaf
hashes offset, length and digest of its record, a node the places and hashes of its ``FANOUT`` children in order and the
offset range they cover. An audit compares the roots and goes down only below nodes that differ, so replicas that agree
cost one comparison and damage costs its branches; what is left at the bottom are the damaged records.

A replica's records take their place in the tree from the kept manifest by record id, so a lost record damages its own
branch and does not shift the others. Where a replica has a manifest of its own, its offsets are hashed: records whose
content is right and whose place is not are told, so neither wrong offsets nor another order of the records passes.
Rows with the same key and address are copies of one record, whose leaf hashes their number and all their digests.
Defined results: a null page body is an empty payload, null keys come first, a null address is
an empty one; an empty table gives an empty report; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import partitions, with_running_total
from footfall.session import materialize

FANOUT = 16
# The tables carry no capture time; a record must have one.
DATE = "1970-01-01T00:00:00Z"


def record_id(key: Column, uri: Column) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), F.coalesce(uri, F.lit(""))))


def record(key: Column, uri: Column, body: Column) -> Column:
    """The bytes of a record, as text."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:md5:"), record_id(key, uri),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), F.coalesce(uri, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def leaves(pages: DataFrame, key: str = "page_id", uri: str = "url", body: str = "html") -> DataFrame:
    """One row per record of a replica: id, key, length, sha256 (least digest of its copies), hash (of all of them)."""
    k, u = F.col(key), F.col(uri)
    text = record(k, u, F.col(body))
    each = pages.select(k.alias("key"), record_id(k, u).alias("id"), text.alias("text"))
    each = each.select("key", "id", F.octet_length("text").cast("long").alias("length"), F.sha2("text", 256).alias("sha256"))
    # A sum of digests is an order-free hash of a multiset, and is added up before the shuffle.
    part = F.conv(F.substring("sha256", 1, 15), 16, 10).cast("decimal(38,0)")
    copies = each.groupBy("id").agg(
        F.min("key").alias("key"), F.sum("length").alias("length"), F.min("sha256").alias("sha256"),
        F.max("sha256").alias("greatest"), F.count(F.lit(1)).alias("n"), F.sum(part).alias("all"),
    )
    digest = F.sha2(F.concat_ws("|", "sha256", "greatest", "n", F.col("all").cast("string")), 256)
    return copies.select("id", "key", "length", "sha256", digest.alias("hash"))


def manifest(replica: DataFrame) -> DataFrame:
    """The leaves with position (from 0) and byte offset in an archive in key order."""
    order = [F.col("key").asc_nulls_first(), "id"]
    ordered = replica.repartitionByRange(partitions(replica.sparkSession), *order).sortWithinPartitions(*order)
    return materialize(with_running_total(ordered, F.col("length"), "offset", "position"), "manifest")


def tree(placed: DataFrame, size: int) -> list[DataFrame]:
    """Levels (node, hash, offset, length) from the leaves up to the one root, for (position, offset, length, hash) of an
    archive of ``size`` records."""
    leaf = F.sha2(F.concat_ws("|", F.col("offset").cast("string"), F.col("length").cast("string"), "hash"), 256)
    level = materialize(placed.select(F.col("position").alias("node"), leaf.alias("hash"), "offset", "length"), "leaves")
    levels = [level]
    while size > 1:
        size = -(-size // FANOUT)
        children = F.array_sort(F.collect_list(F.struct("node", "offset", "length", "hash")))
        one = lambda c: F.concat_ws(":", *[c[x].cast("string") for x in ("node", "offset", "length", "hash")])
        text = F.array_join(F.transform(children, one), ",")
        grouped = level.groupBy(F.expr(f"node DIV {FANOUT}").alias("parent")).agg(
            F.sha2(text, 256).alias("hash"), F.min("offset").alias("offset"), F.sum("length").alias("length")
        )
        level = materialize(grouped.select(F.col("parent").alias("node"), "hash", "offset", "length"), "nodes")
        levels.append(level)
    return levels


def mismatches(one: list[DataFrame], other: list[DataFrame]) -> DataFrame:
    """(node) of the leaves that differ between two trees of the same shape, found from the root down."""
    wanted = None
    for a, b in zip(reversed(one), reversed(other)):
        if wanted is not None:
            below = F.expr(f"node DIV {FANOUT}")
            a = a.join(wanted, below == F.col("bad"), "left_semi")
            b = b.join(wanted, below == F.col("bad"), "left_semi")
        a, b = a.select("node", "hash"), b.select(F.col("node").alias("bad"), F.col("hash").alias("b_hash"))
        differ = a.join(b, F.col("node") == F.col("bad"), "full").where(~F.col("hash").eqNullSafe(F.col("b_hash")))
        wanted = materialize(differ.select(F.coalesce("node", "bad").alias("bad")), "mismatches")
    return wanted


def audit(kept: DataFrame, copy: DataFrame, copy_book: DataFrame | None = None) -> DataFrame:
    """One row per record of either replica (leaves): key, id, position, offset, length, sha256, status.

    ``status`` is ok, corrupt, missing (from the copy), extra (only in the copy; no place) or, with ``copy_book``, the
    copy's own manifest (id, offset), misplaced: whole, but not where the kept manifest has it.
    """
    book = manifest(kept)
    found = materialize(copy, "copy")
    placed = found.select("id", "hash", "length").join(book.select("id", "position", F.col("offset").alias("due")), "id")
    if copy_book is None:
        placed = placed.withColumn("offset", F.col("due"))
    else:
        placed = placed.join(copy_book.select("id", "offset"), "id", "left")
    placed = materialize(placed, "placed")
    size = book.count()
    bad = mismatches(tree(book, size), tree(placed, size))
    there = placed.select("position", F.col("hash").alias("copy_hash"))
    state = bad.join(there, F.col("bad") == F.col("position"), "left").select("bad", "copy_hash", F.col("position").isNotNull().alias("there"))
    status = F.when(F.col("bad").isNull(), "ok").when(~F.col("there"), "missing")
    status = status.when(F.col("hash").eqNullSafe(F.col("copy_hash")), "misplaced").otherwise("corrupt")
    mine = book.join(state, F.col("position") == F.col("bad"), "left").select(
        "key", "id", "position", "offset", "length", "sha256", status.alias("status")
    )
    none = F.lit(None).cast("long")
    extra = found.join(book.select("id"), "id", "left_anti").select(
        "key", "id", none.alias("position"), none.alias("offset"), "length", "sha256", F.lit("extra").alias("status")
    )
    return mine.unionByName(extra)
