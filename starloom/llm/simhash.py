"""Near duplicates by SimHash fingerprints and shared blocks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    arrow_slices,
    column,
    ready_workers,
    row_key,
    shingles,
    stored,
    text_or_empty,
    without_rows,
)
from starloom.llm.components import components

BITS = 64
SEED = 42
#: Buckets of more fingerprints are linked by stars instead of pairs.
PAIRED_BUCKET = 200

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)
#: Row 256 i + v: the bits that byte i sets when it is v.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def text_fingerprint(text: str, words: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; no words give 0."""
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    for block in shingles(text.encode().lower(), words):
        hashes = np.fromiter(map(_hash, block), dtype="<u8", count=len(block))
        total += len(block)
        by_byte = hashes.view(np.uint8).reshape(-1, 8)
        for place in range(8):
            seen = np.bincount(by_byte[:, place], minlength=256)
            ones[8 * place : 8 * place + 8] += seen @ _BYTE_BITS
    packed = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3
) -> DataFrame:
    """``doc_id, fingerprint`` (a signed long) of every row; null texts count as empty."""
    ready_workers(df.sparkSession)
    chosen = df.select(column(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in arrow_slices(batches, ["text"]):
            made = [text_fingerprint(text.as_py(), words) for text in part["text"]]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(made, pa.int64())], ["doc_id", "fingerprint"]
            )

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, fingerprint long")


def _blocks(count: int) -> list[int]:
    """A mask per block; together they cover all bits."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def near_links(distinct: DataFrame, distance: int = 2, block_count: int = 4) -> DataFrame:
    """Links ``left, right`` between fingerprints of at most ``distance`` differing bits.

    ``distinct`` has one column, of different fingerprints. Two close ones differ in at most
    ``distance`` blocks and so agree in a set of ``block_count - distance`` others; they meet in
    that set's bucket, where their distance is checked. All links of small buckets are returned.
    In a bucket of over ``PAIRED_BUCKET``, fingerprints that lie within half the distance of a
    common middle are linked to the least of them: as many rows as members times middles, and
    the same components. That needs an even distance of at most 2; else all pairs are made.
    """
    masks = _blocks(block_count)
    keys = []
    for place, kept in enumerate(combinations(range(block_count), block_count - distance)):
        mask = _signed(sum(masks[i] for i in kept))
        shared = F.col("fingerprint").bitwiseAND(F.lit(mask).cast("long"))
        keys.append(F.struct(F.lit(place).alias("place"), shared.alias("shared")))
    name = distinct.columns[0]
    keyed = distinct.select(column(name).alias("fingerprint")).select(
        "fingerprint", F.explode(F.array(*keys)).alias("key")
    ).select("fingerprint", "key.place", "key.shared")
    sizes = keyed.groupBy("place", "shared").agg(F.count("*").alias("size")).where("size > 1")
    met = stored(keyed.join(sizes, ["place", "shared"]), "buckets")
    by_star = distance in (0, 2)
    paired = met.where(F.col("size") <= PAIRED_BUCKET) if by_star else met
    left = paired.select("place", "shared", F.col("fingerprint").alias("left"))
    right = paired.select("place", "shared", F.col("fingerprint").alias("right"))
    apart = F.bit_count(F.col("left").bitwiseXOR(F.col("right")))
    links = (
        left.join(right, ["place", "shared"])
        .where((F.col("left") < F.col("right")) & (apart <= distance))
        .select("left", "right")
    )
    if not by_star:
        return links
    flips = [F.lit(0).cast("long")]
    if distance == 2:
        flips += [F.lit(_signed(1 << bit)).cast("long") for bit in range(BITS)]
    near = met.where(F.col("size") > PAIRED_BUCKET).select(
        "fingerprint", "place", F.explode(F.array(*flips)).alias("flip")
    )
    near = near.select(
        "fingerprint", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("middle")
    ).distinct()
    hubs = near.groupBy("middle").agg(F.min("fingerprint").alias("hub"))
    stars = near.join(hubs, "middle").where("hub < fingerprint")
    starred = stars.select(F.col("hub").alias("left"), F.col("fingerprint").alias("right"))
    return links.union(starred)


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def simhash_components(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 3,
    distance: int = 2,
) -> DataFrame:
    """``doc_id, fingerprint, component_id, component_size`` of every row.

    Rows are linked when their fingerprints differ in at most ``distance`` bits; rows of one
    component reach each other over links, and its id is its smallest ``doc_id``. Equal
    fingerprints are one class, which is linked once however many rows it has.

    Null or empty texts have the fingerprint zero and are linked like any other. Null ids never
    become a component's id unless it has no other. Repeated rows are members each. An empty
    table gives an empty result; other columns of the input are not looked at.
    """
    rows = stored(fingerprints(df, id_column, text_column, words), "fingerprints")
    classes = stored(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count("*").alias("size")),
        "classes",
    )
    rooted = components(near_links(classes.select("fingerprint"), distance))
    rooted = rooted.withColumnRenamed("node", "fingerprint")
    named = stored(
        classes.join(rooted, "fingerprint", "left").withColumn(
            "root", F.coalesce("root", "fingerprint")
        ),
        "rooted",
    )
    whole = named.groupBy("root").agg(
        F.min("least").alias("component_id"), F.sum("size").alias("component_size")
    )
    members = named.select("fingerprint", "root").join(whole, "root")
    return rows.join(members, "fingerprint").select(
        "doc_id", "fingerprint", "component_id", "component_size"
    )


def keep_one_of_component(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words: int = 3,
    distance: int = 2,
) -> DataFrame:
    """The rows of ``df`` with one document per component, that of the smallest id.

    A document is a row's id and text: rows repeated with both stay or go together, and of
    several texts with a component's smallest id, that of the smallest digest stays. Null ids
    lose against any other; in a component that has no other, one document stays. Null texts
    count as empty, and texts without words are one component. Long texts are read in blocks.
    An empty table stays empty. Columns may have any names.
    """
    keyed = df.select(
        row_key(id_column, text_column).alias("key"), text_or_empty(text_column).alias("text")
    )
    rows = stored(fingerprints(keyed, "key", "text", words), "fingerprints")
    rows = rows.select(F.col("doc_id").alias("key"), "fingerprint")
    rank = F.struct(
        F.col("key.doc_id").isNull().alias("no_id"),
        F.col("key.doc_id").alias("doc_id"),
        F.col("key.text_md5").alias("text_md5"),
    )
    least = rows.groupBy("fingerprint").agg(F.min(rank).alias("least"))
    classes = stored(least, "classes")
    rooted = components(near_links(classes.select("fingerprint"), distance))
    named = classes.join(rooted.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = stored(named.withColumn("root", F.coalesce("root", "fingerprint")), "rooted")
    first = named.groupBy("root").agg(F.min("least").alias("first"))
    chosen = stored(named.join(first, "root").select("fingerprint", "first"), "chosen")
    dropped = rows.join(chosen, "fingerprint").where(
        ~F.col("key.doc_id").eqNullSafe(F.col("first.doc_id"))
        | (F.col("key.text_md5") != F.col("first.text_md5"))
    )
    return without_rows(df, dropped.select("key"), id_column, text_column)
