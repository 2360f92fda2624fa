"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check.

A pair at distance d <= 4 leaves at least two of six blocks of a fingerprint
untouched, so each fingerprint is filed under the 15 pairs of blocks and only
fingerprints sharing such a key are compared.  Everything runs on distinct
fingerprints; exact copies meet only in two hash aggregations.

A key's group is never held whole: groups of at most SMALL_GROUP are joined;
larger ones are cut into sections of SECTION fingerprints and every pair of
sections is one bounded numpy task that returns a spanning forest of its
links, not all of them; members of groups above LARGE_GROUP link through the
points at half the distance around them instead (two fingerprints are at most
4 bits apart exactly if the 2-bit neighbourhoods of both meet), which is
linear in the group.  All three ways find the same classes.

Defined results: null and wordless texts have fingerprint zero and link like
any other; a null id gets its class's smallest non-null id (null if it has
none); repeated rows stay rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import add_columns, boxed, unboxed
from corpusmill.operators.graph import connected_components
from corpusmill.operators.neardup import salted_join_sides
from corpusmill.session import reliable_checkpoint

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SMALL_GROUP = 48
SECTION = 1024
LARGE_GROUP = 32 * SECTION
#: A join key with more rows is salted.
HOT_ROWS = 20_000
LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The set bits of each byte value, least significant first.
BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def shingles(text: str | None, n: int = SHINGLE) -> list[bytes]:
    """Lower-cased n-word shingles in order, repeats included; the whole sequence if it is shorter."""
    words = text.encode().translate(LOWER_TABLE).split() if text else []
    if not words:
        return []
    if len(words) <= n:
        return [b" ".join(words)]
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    return [joined[a:b] for a, b in zip(starts, stops[n - 1:])]


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """64-bit SimHash as a signed number: a bit is set if it is in over half of the hashes."""
    parts = shingles(text, n)
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in parts), np.uint64, len(parts))
    lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ BYTE_BITS for k in range(8)])
    bits = (2 * counts > len(parts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", n: int = SHINGLE, out: str = "simhash",
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of each text as column ``out``."""
    return add_columns(docs, [text_col], f"`{out}` long",
                       lambda: lambda texts: [[fingerprint(t, n) for t in texts]], keep)


def block_masks(max_bits: int = MAX_BITS, blocks: int | None = None) -> list[int]:
    """Masks whose keys meet for every pair of at most ``max_bits`` differing bits:
    all choices of the blocks that such a pair must leave untouched."""
    blocks = blocks or max_bits + 2
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(parts, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def forest(points: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (each point's label, point) that join the classes of points at most ``max_bits`` apart."""
    near = popcount(points[:, None] ^ points[None, :]) <= max_bits
    label = np.arange(len(points))
    big = len(points)
    while True:
        new = np.where(near, label[None, :], big).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(len(points)))
    return points[label[at]], points[at]


def section_links(max_bits: int):
    def run(table: pa.Table) -> pa.Table:
        points = np.unique(table.column("fp").to_numpy()).view(np.uint64)
        a, b = forest(points, max_bits)
        return pa.table({"src": a.view(np.int64), "dst": b.view(np.int64)})

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, small: int = SMALL_GROUP, section: int = SECTION,
          large: int = LARGE_GROUP) -> DataFrame:
    """Links (src, dst) that span the classes of distinct fingerprints ``fp``."""
    masks = block_masks(max_bits)
    keyed = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(masks)])).alias("k")).select("fp", "k.t", "k.key")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    grouped = reliable_checkpoint(keyed.join(sizes, ["t", "key"]))
    few = grouped.where(F.col("size") <= small)
    pairs = (few.select("t", "key", F.col("fp").alias("src"))
             .join(few.select(F.col("t").alias("t2"), F.col("key").alias("key2"), F.col("fp").alias("dst")),
                   (F.col("t") == F.col("t2")) & (F.col("key") == F.col("key2")) & (F.col("src") < F.col("dst"))
                   & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= max_bits))
             .select("src", "dst"))
    # pairs of sections: a fingerprint of section s goes to (min, max) of s with every other section
    mid = (grouped.where((F.col("size") > small) & (F.col("size") <= large))
           .withColumn("n", F.ceil(F.col("size") / section).cast("int"))
           .withColumn("s", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
           .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
           .select("t", "key", F.least("s", "o").alias("x"), F.greatest("s", "o").alias("y"), "fp"))
    spans = mid.groupBy("t", "key", "x", "y").applyInArrow(section_links(max_bits), "src long, dst long")
    hot = grouped.where(F.col("size") > large).select("fp").distinct()
    return pairs.unionByName(spans).unionByName(ball_links(hot, max_bits)).distinct()


def ball_links(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links of points at most ``max_bits`` (even) apart through the points within half of it around each."""
    if max_bits % 2:
        raise ValueError("the neighbourhood form needs an even distance")
    flips = [sum(1 << b for b in c) for r in range(max_bits // 2 + 1) for c in combinations(range(64), r)]
    signed = [f - (1 << 64) if f >> 63 else f for f in flips]
    around = points.select("fp", F.explode(F.array(*[F.lit(f) for f in signed])).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near"))
    centre = around.groupBy("near").agg(F.min("fp").alias("src"))
    hub = around.join(centre, "near").where(F.col("src") != F.col("fp"))
    return hub.select("src", F.col("fp").alias("dst")).distinct()


def members(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE,
            max_bits: int = MAX_BITS, small: int = SMALL_GROUP, section: int = SECTION,
            large: int = LARGE_GROUP) -> tuple[DataFrame, DataFrame]:
    """Rows as (id, simhash), and the distinct fingerprints as (fp, rows, least, label):
    how many rows have it, their smallest id, and the class."""
    prints = reliable_checkpoint(fingerprints(
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t")), "t", n, keep=["id"]))
    distinct = reliable_checkpoint(
        prints.groupBy(F.col("simhash").alias("fp")).agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")))
    labels = connected_components(links(distinct.select("fp"), max_bits, small, section, large))
    named = distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
        "fp", "rows", "least", F.coalesce("cluster_id", "fp").alias("label"))
    return prints, reliable_checkpoint(named)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(id, simhash, component_id): component_id is the smallest id of the class."""
    prints, named = members(docs, id_col, text_col, **settings)
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of = attach(named.select("fp", "label"), "label", named, least, "fp").select(
        F.col("fp").alias("simhash"), "component_id")
    return attach(prints, "simhash", named, of, "id").select(F.col("id").alias(id_col), "simhash", "component_id")


def attach(rows: DataFrame, key: str, named: DataFrame, target: DataFrame, row_id: str) -> DataFrame:
    """``rows`` joined with the unique keys of ``target``; a key that more than HOT_ROWS rows have
    (a fingerprint or a class may have a third of them) is salted."""
    weight, name = (F.sum("rows"), "fp") if key == "simhash" else (F.count(F.lit(1)), key)
    hot = (named.groupBy(F.col(name).alias(key)).agg(weight.alias("n")).where(F.col("n") > HOT_ROWS)
           .select(key, F.ceil(F.col("n") / F.lit(HOT_ROWS)).cast("int").alias("_salts")))
    big, small, keys = salted_join_sides(rows, target, [key], hot, row_id)
    return big.join(small, keys)


def report(docs: DataFrame) -> DataFrame:
    """The contract's columns of a documents table."""
    return classes(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, unchanged: one row of the class's smallest id, or of a null
    id if the class has no other."""
    prints, named = members(docs, id_col, text_col)
    label = named.select(F.col("fp").alias("simhash"), "label")
    # of each class the smallest id, nulls last, and the smallest of its fingerprints
    first = (attach(prints, "simhash", named, label, "id").groupBy("label")
             .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "simhash")).alias("first"))
             .select("first.*"))
    keys = ["simhash", "no_id", "id_text"]
    id_text = F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id_text")
    first = first.select("simhash", "no_id", id_text)
    rows = fingerprints(boxed(docs, id=id_col, t=text_col), "t", keep=["row", "id"])
    rows = rows.select("row", "simhash", F.col("id").isNull().alias("no_id"), id_text)
    return unboxed(rows.join(first, keys, "left_semi").dropDuplicates(keys))
