"""Exact near-duplicate join (JN1-JN4, JN6).

A pair of documents is a near duplicate when the Jaccard similarity of
their token *sets* is >= ``key_threshold`` and the Jaccard similarity of
their token *multisets* (sum of min counts / sum of max counts) is >=
``threshold``.  Equality passes.

Plan (published set-similarity joins: All-Pairs, PPJoin, and their
MapReduce form):

1. bags (id, token, cnt) counted where the document is, in a global token
   order by document frequency;
2. exact-copy collapse: documents with identical bags share one
   representative, so a copy group of any size costs one row downstream;
3. candidates: small corpora join the rarest-token *prefix* of every
   representative on (token id, occurrence, length band) and filter the
   aggregated pairs; others count shared prefix elements by pairs of blocks
   (``blocks``), which writes no row for a pair that does not pass;
4. a lower bound of the difference from parity bitmaps drops candidates before
   token arrays are moved;
5. verification: small corpora use native array functions (set overlap) and a
   map merge (multiset overlap) on the few survivors; pairs of blocks compare
   whole bags in the task that found the pair, and shuffle none.

The output is exact: the filters only drop pairs that cannot pass.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators.bags import MIN_TOKENS
from corpusmill.operators.blocks import HOT_TID, block_candidates, block_size, written_blocks
from corpusmill.session import adaptive_caching, release, reliable_checkpoint, shuffles_dropped

EPS = 1e-9  # slack that keeps every floating-point filter conservative


# The most frequent tokens whose order every task knows (all others come before them, in the
# order of their hashes), hash seeds tried, bytes of an Arrow batch that goes to Python code, and entries of bags
# and vocabulary that are counted into one row.
RANKED_TOKENS = 200_000
TOKEN_SEEDS = 8
BATCH_BYTES = 8 << 20
COUNTED_ENTRIES = 3_000_000


def token_hash(token, seed: int):
    """Token id of 62 bits, below ``HOT_TID``."""
    return F.xxhash64(token, F.lit(seed)).bitwiseAND(F.lit(HOT_TID - 1))


def token_ranks(d: DataFrame, df_col: str | None = None) -> tuple[int, np.ndarray]:
    """(seed, hashes): a seed under which no two tokens of the corpus share a hash, and the
    RANKED_TOKENS most frequent tokens' hashes, rarest first.

    ``df_col``: how many documents a token of ``tokens`` stands in, if a row is not one document.
    """
    # explode_outer and a filter: see ``token_bag``
    if df_col is None:
        tokens = d.select(F.explode_outer(F.array_distinct("tokens")).alias("token"), F.lit(1).alias("df"))
    else:
        tokens = d.select(F.explode_outer(F.arrays_zip(F.col("tokens").alias("token"), F.col(df_col).alias("df"))).alias("t")).select("t.*")
    vocab = reliable_checkpoint(
        tokens.where(F.col("token").isNotNull()).groupBy("token").agg(F.sum(F.col("df").cast("long")).alias("df")), "zstd")
    try:
        with shuffles_dropped(d.sparkSession):
            for seed in range(TOKEN_SEEDS):
                h = vocab.select(token_hash(F.col("token"), seed).alias("h"))
                if not h.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1):
                    break
            else:
                raise RuntimeError("tokens share hashes under every seed")
            top = vocab.orderBy(F.col("df").desc(), F.col("token").desc()).limit(RANKED_TOKENS)
            ranked = top.select(token_hash(F.col("token"), seed).alias("h")).toArrow().column("h").to_numpy()
            return seed, ranked[::-1].copy()
    finally:
        release(vocab)


def counted_batches(d: DataFrame) -> DataFrame:
    """(ids, k, numbers, cnts, tokens, df): a row for some thousand documents (id, tokens).

    Bags are counted on the numbers of the distinct tokens of these documents, so that the
    tokens of a document are computed once, and a token is written once for all of them.
    """
    spark = d.sparkSession
    adaptive_caching(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    arrays = [T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("df", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([T.StructField("ids", T.ArrayType(d.schema["id"].dataType)),
                           *[T.StructField(c, T.BinaryType()) for c in ("k", "numbers", "cnts")], *arrays])

    def counted(batch):
        """(ids, k, numbers, cnts, tokens) of a batch."""
        column = batch.column("tokens")
        lens = np.array(pc.fill_null(pc.list_value_length(column), 0), np.int64)
        coded = column.flatten().dictionary_encode()
        doc, number = np.repeat(np.arange(len(lens)), lens), pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
        distinct = max(len(coded.dictionary), 1)
        key = np.sort((doc * distinct + number)[number >= 0])
        first = np.flatnonzero(np.diff(key, prepend=-1) != 0)
        doc, number = np.divmod(key[first], distinct)
        return batch.column("id"), np.bincount(doc, minlength=len(lens)), number, np.diff(np.append(first, len(key))), coded.dictionary

    def together(held):
        """One row of the batches ``held``, their tokens numbered anew."""
        ids, k, numbers, cnts, tokens = zip(*held)
        coded = pa.concat_arrays(tokens).dictionary_encode()
        anew, base = coded.indices.to_numpy(zero_copy_only=False), np.cumsum([0, *map(len, tokens)])
        numbers = np.concatenate([anew[at + n] for at, n in zip(base, numbers)])
        one = lambda values: pa.array([values.astype("<i4").tobytes()], pa.binary())
        row = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        df = pa.array(np.bincount(numbers, minlength=len(coded.dictionary)), pa.int32())
        return pa.RecordBatch.from_arrays([row(pa.concat_arrays(ids)), one(np.concatenate(k)), one(numbers), one(np.concatenate(cnts)),
                                           row(coded.dictionary), row(df)], names=schema.names)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(counted(batch))
            n += len(held[-1][2]) + len(held[-1][4])
            if n >= COUNTED_ENTRIES:
                yield together(held)
                held, n = [], 0
        if held:
            yield together(held)

    return reliable_checkpoint(d.mapInArrow(run, schema), "zstd")


def signatures(docs: DataFrame, id_col: str = "id", tokens_col: str = "tokens",
               minimum: int = MIN_TOKENS) -> DataFrame:
    """Per document: bag entries sorted by the global order, n and k.

    Output: id, entries array<struct<tid bigint, cnt bigint>>, n, k, h (SHA-256 of the entries).
    Ids are unique, so a bag is counted where its document is; a token's id is its
    hash, checked over the vocabulary to be its own, or its rank among the frequent
    ones.  No row for an occurrence is shuffled; the tokens are computed once, the result
    is written once.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("id"), F.col(tokens_col).alias("tokens"))
    counted = counted_batches(d)
    seed, ranked = token_ranks(counted.select("tokens", "df"), "df")
    by_hash = np.argsort(ranked, kind="stable")
    sent = spark.sparkContext.broadcast((ranked[by_hash], by_hash))
    hashes = F.transform("tokens", lambda t: token_hash(t, seed))
    # any global order is valid: the frequent tokens come last
    schema = T.StructType([d.schema["id"], *T._parse_datatype_string(
        "entries array<struct<tid: bigint, cnt: bigint>>, n bigint, k bigint, h binary").fields])

    def bags(ids, k, number, cnt, tid):
        """The bags of one batch; ``tid`` has the hashes of its distinct tokens."""
        known, rank = sent.value
        if len(known):
            at = np.minimum(np.searchsorted(known, tid), len(known) - 1)
            tid = np.where(known[at] == tid, HOT_TID + rank[at], tid)
        place = np.empty(len(tid), np.int64)
        place[np.argsort(tid)] = np.arange(len(tid))
        order = np.argsort(np.repeat(np.arange(len(k)), k) * max(len(tid), 1) + place[number])
        tid, cnt = tid[number[order]], cnt[order].astype(np.int64)
        ends = np.append(0, np.cumsum(k))
        upto = np.append(0, np.cumsum(cnt))[ends]
        entries = pa.StructArray.from_arrays([pa.array(tid, pa.int64()), pa.array(cnt, pa.int64())], names=["tid", "cnt"])
        digests = [hashlib.sha256(tid[a:b].tobytes() + cnt[a:b].tobytes()).digest() for a, b in zip(ends, ends[1:])]
        return pa.RecordBatch.from_arrays(
            [ids, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries), pa.array(np.diff(upto), pa.int64()),
             pa.array(k, pa.int64()), pa.array(digests, pa.binary())], names=["id", "entries", "n", "k", "h"])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                k, number, cnt = (np.frombuffer(batch.column(c)[i].as_py(), "<i4") for c in ("k", "numbers", "cnts"))
                hashed = batch.column("tokens")[i].values.to_numpy(zero_copy_only=False)
                yield bags(batch.column("ids")[i].values, k.astype(np.int64), number, cnt, hashed)

    sig = counted.select("ids", "k", "numbers", "cnts", hashes.alias("tokens")).mapInArrow(run, schema)
    # PRJ6 on the counted total (equals size(tokens))
    written = reliable_checkpoint(sig.where((F.col("n") >= minimum) & (F.col("k") > 0)), "zstd")
    release(counted)
    return written


def collapse_copies(sig: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Group identical bags.

    Returns (reps, members):
      reps(rep, entries, n, k, copies)  one row per distinct bag;
      members(id, rep)                  every document and its representative.
    Bags are equal when their SHA-256 is; only ids and digests are shuffled, the copy
    groups salted by their known size, and the entries are read where they were written.
    """
    groups = sig.groupBy("h").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    groups = groups.persist(StorageLevel.MEMORY_AND_DISK)
    # a copy group is a hot key of this join: salt it by the known copy count
    big, small, keys = salted_join_sides(sig.select("id", "h"), groups.select("h", "rep"), ["h"],
                                         hot_copy_groups(groups, "h"), "id")
    members = reliable_checkpoint(big.join(small, keys).select("id", "rep"))
    groups.unpersist()
    copies = members.where(F.col("id") != F.col("rep")).select("id")
    repeated = members.groupBy("rep").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    if copies.count() <= HOT_KEYS_BROADCAST:
        copies, repeated = F.broadcast(copies), F.broadcast(repeated)
    reps = (sig.drop("h").join(copies, "id", "left_anti").withColumnRenamed("id", "rep").join(repeated, "rep", "left")
            .select("rep", "entries", "n", "k", F.coalesce("copies", F.lit(1)).alias("copies")))
    return reps, members


def _elements(multiset: bool):
    """Set elements used for candidate generation, in the global order."""
    if multiset:
        return F.flatten(F.transform(
            "entries",
            lambda e: F.transform(F.sequence(F.lit(1), e["cnt"].cast("int")),
                                  lambda o: F.struct(e["tid"].alias("tid"), o.alias("occ")))))
    return F.transform("entries", lambda e: F.struct(e["tid"].alias("tid"), F.lit(1).alias("occ")))


def _band(size, th: float):
    """Length band: pairs that can pass differ by at most one band."""
    if th >= 1.0:
        return size.cast("long")
    return F.floor(F.log(size.cast("double")) / F.lit(math.log(1.0 / th))).cast("long")


# Fixed values for hot prefix keys: a key with more than HOT_KEY_ROWS rows on
# the indexing side is split into ceil(rows / HOT_KEY_ROWS) salt buckets; the
# hot-key table is broadcast only when it has at most HOT_KEYS_BROADCAST rows.
HOT_KEY_ROWS = 20_000
HOT_KEYS_BROADCAST = 1_000_000


def salted_join_sides(big: DataFrame, small: DataFrame, keys: list[str], hot: DataFrame,
                      big_id: str, hot_keys: list[str] | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Prepare a join whose ``big`` side may hold very large key groups.

    ``hot`` lists the hot keys with their bucket count ``_salts`` (it is
    broadcast when it has at most HOT_KEYS_BROADCAST rows, checked by the
    caller).  Big-side rows of a hot key are spread over ``_salts`` buckets by
    a hash of ``big_id``; small-side rows of that key are copied to every
    bucket; other keys keep bucket 0.  Joining on ``keys + ['_salt']`` gives
    exactly the rows of the plain join.  ``hot_keys`` (default ``keys``) may
    be a prefix of ``keys`` such as a hash: rows sharing it are salted alike.
    """
    hot_keys = hot_keys or keys
    with shuffles_dropped(hot.sparkSession):
        n_hot = hot.count()
    if n_hot == 0:
        return big, small, keys
    hot_t = F.broadcast(hot) if n_hot <= HOT_KEYS_BROADCAST else hot
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    big_s = (big.join(hot_t, hot_keys, "left")
             .withColumn("_salt", F.pmod(F.xxhash64(big_id), salts).cast("int")).drop("_salts"))
    small_s = (small.join(hot_t, hot_keys, "left")
               .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts"))
    return big_s, small_s, keys + ["_salt"]


def _salt_hot_keys(long_side: DataFrame, short_side: DataFrame, keys: list[str],
                   hot_rows: int = HOT_KEY_ROWS) -> tuple[DataFrame, DataFrame, list[str]]:
    """Split hot keys of the prefix join: short-side rows of a key with more
    than ``hot_rows`` rows go to ceil(rows / hot_rows) buckets, the long-side
    rows of that key are copied to each bucket."""
    stats = short_side.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = (stats.where(F.col("_rows") > hot_rows)
           .select(*keys, F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int").alias("_salts")))
    short, long_, k = salted_join_sides(short_side, long_side, keys, hot, "y")
    return long_, short, k


def hot_copy_groups(reps: DataFrame, key: str = "rep", hot_rows: int | None = None) -> DataFrame:
    """(key, _salts) for copy groups with more than ``hot_rows`` (HOT_KEY_ROWS) members."""
    hot_rows = HOT_KEY_ROWS if hot_rows is None else hot_rows
    return (reps.where(F.col("copies") > hot_rows)
            .select(key, F.ceil(F.col("copies") / F.lit(hot_rows)).cast("int").alias("_salts")))


def candidate_pairs(reps: DataFrame, key_threshold: float, threshold: float) -> DataFrame:
    """Prefix + length + positional filtered candidates (x, y) among representatives.

    Role "long" (x) indexes the prefix of length s - ceil(t*s) + 1, role
    "short" (y, the smaller record in (size, id) order) the shorter prefix
    s - ceil(2t/(1+t)*s) + 1.  Every unordered pair is generated once.
    """
    multiset = key_threshold <= 0.0
    th = threshold if multiset else key_threshold
    if th <= 0.0:
        raise ValueError("both thresholds are 0: every pair qualifies; refusing a cross join")
    size = F.col("n") if multiset else F.col("k")
    base = reps.select(F.col("rep").alias("id"), "n", "k", size.alias("s"), _elements(multiset).alias("el"))
    s = F.col("s")
    p_long = s - F.ceil(s * F.lit(th) - F.lit(EPS)) + 1
    p_mid = s - F.ceil(s * F.lit(2 * th / (1 + th)) - F.lit(EPS)) + 1
    if th >= 1.0:
        lo_band = hi_band = s.cast("long")
    else:
        logb = math.log(1.0 / th)
        lo_band = F.floor(F.log(s * F.lit(th)) / F.lit(logb) - F.lit(EPS)).cast("long")
        hi_band = F.floor(F.log(s.cast("double")) / F.lit(logb) + F.lit(EPS)).cast("long")

    long_side = (base.select(
        F.col("id").alias("x"), F.col("s").alias("sx"), F.col("n").alias("nx"), F.col("k").alias("kx"),
        F.explode(F.sequence(lo_band, hi_band)).alias("band"),
        F.posexplode(F.slice("el", 1, p_long.cast("int"))).alias("px", "e"))
        .select("x", "sx", "nx", "kx", "band", "px", F.col("e.tid").alias("tid"), F.col("e.occ").alias("occ")))
    short_side = (base.select(
        F.col("id").alias("y"), F.col("s").alias("sy"), F.col("n").alias("ny"), F.col("k").alias("ky"),
        _band(s, th).alias("band"),
        F.posexplode(F.slice("el", 1, p_mid.cast("int"))).alias("py", "e"))
        .select("y", "sy", "ny", "ky", "band", "py", F.col("e.tid").alias("tid"), F.col("e.occ").alias("occ")))

    other = F.lit(key_threshold if multiset else threshold)
    other_small = F.least("kx", "ky") if multiset else F.least("nx", "ny")
    other_big = F.greatest("kx", "ky") if multiset else F.greatest("nx", "ny")
    long_side, short_side, keys = _salt_hot_keys(long_side, short_side, ["tid", "occ", "band"])
    joined = long_side.join(short_side, keys).where(
        ((F.col("sy") < F.col("sx")) | ((F.col("sy") == F.col("sx")) & (F.col("y") < F.col("x"))))
        & (F.col("sy") >= F.col("sx") * F.lit(th) - F.lit(EPS))
        & (other_small >= other_big * other - F.lit(EPS)))
    grouped = joined.groupBy("x", "y", "sx", "sy").agg(
        F.count(F.lit(1)).alias("m"), F.max("px").alias("i"), F.max("py").alias("j"))
    need = F.ceil((F.col("sx") + F.col("sy")) * F.lit(th / (1 + th)) - F.lit(EPS))
    bound = F.col("m") + F.least(F.col("sx") - F.col("i") - 1, F.col("sy") - F.col("j") - 1)
    return grouped.where(bound >= need).select("x", "y")


# Fixed bound (bytes) under which the representatives' bitmaps, and their key
# arrays, are broadcast; above it they are shuffle-joined.
VERIFY_BROADCAST_BYTES = 64 * 1024 * 1024

# Fixed bound (bytes of key arrays) of the prefix join, whose rows grow with the square of the
# corpus; above it candidates come from pairs of blocks.
PREFIX_JOIN_BYTES = 8 * 1024 * 1024

# Fixed width of a parity bitmap in words of 64 bits.
SKETCH_WORDS = 16


def parity_sketches(reps: DataFrame, multiset: bool, words: int = SKETCH_WORDS) -> DataFrame:
    """(id, s, w0, w1, ...): size and parity bitmap of each representative's elements.

    Every element is hashed to one of 64 * words bits; a bit says whether an
    odd number of elements fell on it.  An element of both records flips the
    same bit in both, so the bits in which two bitmaps differ are at most as
    many as the elements in which the records differ.
    """
    size = F.col("n") if multiset else F.col("k")
    e = reps.select(F.col("rep").alias("id"), size.alias("s"), F.explode(_elements(multiset)).alias("e"))
    e = e.select("id", "s", F.pmod(F.xxhash64("e.tid", "e.occ"), F.lit(64 * words)).cast("int").alias("bit"))
    # shiftleft takes its distance modulo 64, so the low six bits of the number count
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    word = F.floor(F.col("bit") / 64)
    return e.groupBy("id").agg(F.first("s").alias("s"), *[
        F.bit_xor(F.when(word == w, one).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(words)])


def difference_filter(cands: DataFrame, reps: DataFrame, key_threshold: float, threshold: float,
                      words: int = SKETCH_WORDS, broadcast_bytes: int = VERIFY_BROADCAST_BYTES) -> DataFrame:
    """Candidates (x, y) whose records may be similar enough by their parity bitmaps.

    Records of sizes a and b that reach the threshold differ in at most
    a + b - 2 * need elements; a pair whose bitmaps differ in more bits cannot
    pass.  The bitmaps (a fixed 8 * words bytes, whatever the record) are joined to the
    grouped candidates, not carried by every row of the prefix join.
    """
    multiset = key_threshold <= 0.0
    th = threshold if multiset else key_threshold
    sketches = parity_sketches(reps, multiset, words)
    if reps.count() * (8 * words + 24) <= broadcast_bytes:
        sketches = F.broadcast(sketches)
    side = lambda end: sketches.select(
        F.col("id").alias(end), F.col("s").alias("s" + end), *[F.col(f"w{w}").alias(f"{end}{w}") for w in range(words)])
    differ = sum((F.bit_count(F.col(f"x{w}").bitwiseXOR(F.col(f"y{w}"))) for w in range(words)), F.lit(0))
    both = F.col("sx") + F.col("sy")
    need = F.ceil(both * F.lit(th / (1 + th)) - F.lit(EPS))
    return cands.join(side("x"), "x").join(side("y"), "y").where(differ <= both - 2 * need).select("x", "y")


def _key_bytes(reps: DataFrame) -> int:
    return 8 * (reps.agg(F.sum("k")).first()[0] or 0)


def verify_pairs(cands: DataFrame, reps: DataFrame, key_threshold: float,
                 threshold: float, broadcast_bytes: int = VERIFY_BROADCAST_BYTES) -> DataFrame:
    """Exact similarities for candidate pairs; keep those passing both thresholds.

    Two phases keep the moved payload small: the set overlap needs only the
    sorted key-id arrays (8 bytes per distinct token); the bag merge for the
    multiset overlap reads whole bags for the survivors of phase one.  The
    key arrays are broadcast only when their measured total size is under
    ``broadcast_bytes``; otherwise each candidate ships one array through a
    shuffle.
    """
    keys = reps.select("rep", F.col("entries.tid").alias("keys"), "k")
    if _key_bytes(reps) <= broadcast_bytes:
        keys = F.broadcast(keys)
    a = keys.select(F.col("rep").alias("x"), F.col("keys").alias("xa"), F.col("k").alias("ka"))
    b = keys.select(F.col("rep").alias("y"), F.col("keys").alias("yb"), F.col("k").alias("kb"))
    # the overlap appears once in the pre-filter (the optimizer inlines a
    # filter into the join condition, where repeated subexpressions are not
    # shared); ko/(ka+kb-ko) >= t  <=>  ko*(1+t) >= t*(ka+kb), with slack
    pre = (F.size(F.array_intersect("xa", "yb")) * F.lit(1.0 + key_threshold)
           >= (F.col("ka") + F.col("kb")) * F.lit(key_threshold) - F.lit(EPS))
    phase1 = cands.join(a, "x").join(b, "y").where(pre)
    phase1 = phase1.select("x", "y", "ka", "kb", F.size(F.array_intersect("xa", "yb")).alias("ko"))
    union = F.col("ka") + F.col("kb") - F.col("ko")
    key_sim = F.when(union == 0, F.lit(0.0)).otherwise(F.col("ko") / union)
    survivors = phase1.withColumn("key_jaccard", key_sim).where(F.col("key_jaccard") >= F.lit(key_threshold))

    bags = reps.select("rep", "entries", "n")
    ea = bags.select(F.col("rep").alias("x"), F.col("entries").alias("ea"), F.col("n").alias("na"))
    eb = bags.select(F.col("rep").alias("y"), F.col("entries").alias("eb"), F.col("n").alias("nb"))
    ms = F.aggregate(
        F.map_values(F.map_zip_with(F.map_from_entries("ea"), F.map_from_entries("eb"),
                                    lambda _k, v1, v2: F.least(F.coalesce(v1, F.lit(0)),
                                                               F.coalesce(v2, F.lit(0))))),
        F.lit(0).cast("long"), lambda acc, v: acc + v)
    j = survivors.join(ea, "x").join(eb, "y").withColumn("mo", ms)
    denom = F.col("na") + F.col("nb") - F.col("mo")
    sim = F.when(denom == 0, F.lit(0.0)).otherwise(F.col("mo") / denom)
    return (j.withColumn("jaccard", sim)
            .where(F.col("jaccard") >= F.lit(threshold))
            .select(F.least("x", "y").alias("id1"), F.greatest("x", "y").alias("id2"),
                    "jaccard", "key_jaccard"))


class NearDuplicates:
    """Result of the near-duplicate join in compact form.

    rep_pairs  similar pairs among distinct bags (id1 < id2)
    members    every indexed document and its bag representative
    reps       distinct bags with their copy count
    """

    def __init__(self, rep_pairs: DataFrame, members: DataFrame, reps: DataFrame):
        self.rep_pairs = rep_pairs
        self.members = members
        self.reps = reps

    def close(self) -> None:
        """Release the caches and files behind the pairs, copies and distinct bags."""
        for df in (self.rep_pairs, self.members, self.reps):
            df.unpersist()
            release(df)

    def edges(self) -> DataFrame:
        """Compact edge list (src, dst) whose closure equals the full pair graph.

        Similar representatives plus a star from each representative to its
        copies: O(documents + similar bags), never all pairs inside a copy group.
        """
        stars = self.members.where(F.col("id") != F.col("rep")).select(
            F.col("rep").alias("src"), F.col("id").alias("dst"))
        return self.rep_pairs.select(F.col("id1").alias("src"), F.col("id2").alias("dst")).unionByName(stars)

    def all_pairs(self) -> DataFrame:
        """The flat pair list (the reference's pair log): every similar pair.

        Its size is the size of the answer; a copy group of g documents
        contributes g*(g-1)/2 rows here by definition.  Downstream operators
        use ``edges`` instead.
        """
        hot = hot_copy_groups(self.reps)

        def with_copies(rows: DataFrame, key: str, name: str) -> DataFrame:
            """Each row once for every copy of its representative ``key``; large copy groups are salted."""
            copies = self.members.select(F.col("rep").alias(key), F.col("id").alias(name))
            big, small, keys = salted_join_sides(copies, rows, [key], hot.withColumnRenamed("rep", key), name)
            return big.join(small, keys).drop("_salt")

        similar = self.rep_pairs.select("id1", "id2", "jaccard", "key_jaccard")
        cross = (with_copies(with_copies(similar, "id1", "a"), "id2", "b")
                 .select(F.least("a", "b").alias("id1"), F.greatest("a", "b").alias("id2"),
                         "jaccard", "key_jaccard"))
        members = self.members.select("rep", F.col("id").alias("a"))
        copies = (with_copies(members, "rep", "b").where(F.col("a") < F.col("b"))
                  .select(F.col("a").alias("id1"), F.col("b").alias("id2"),
                          F.lit(1.0).alias("jaccard"), F.lit(1.0).alias("key_jaccard")))
        return cross.unionByName(copies)


def unique_ids(docs: DataFrame, id_col: str = "id", on_duplicate: str = "raise",
               order_col: str | None = None) -> DataFrame:
    """One row per id.  A repeated id is an error (``raise``), or its row with the largest
    ``order_col`` stays (``last``); documents of one id are never merged."""
    if on_duplicate == "raise":
        again = docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(id_col).take(1)
        if again:
            raise ValueError(f"id {again[0][0]!r} stands for more than one document; "
                             "pass on_duplicate='last' and an order column")
        return docs
    if on_duplicate != "last" or order_col is None:
        raise ValueError("on_duplicate is 'raise', or 'last' with an order column")
    others = [c for c in docs.columns if c not in (id_col, order_col)]
    return (docs.groupBy(id_col).agg(F.max_by(F.struct(order_col, *others), order_col).alias("_row"))
            .select(id_col, "_row.*"))


def near_duplicates(docs: DataFrame, id_col: str = "id", tokens_col: str = "tokens",
                    key_threshold: float = 0.5, threshold: float = 0.5,
                    minimum: int = MIN_TOKENS, on_duplicate: str = "raise",
                    order_col: str | None = None,
                    broadcast_bytes: int = VERIFY_BROADCAST_BYTES) -> NearDuplicates:
    """JN1 in compact form.  Ids must be unique, see ``unique_ids``."""
    if not (0.0 <= key_threshold <= 1.0 and 0.0 <= threshold <= 1.0):
        raise ValueError("thresholds must be within [0, 1]")
    docs = unique_ids(docs, id_col, on_duplicate, order_col)
    sig = signatures(docs, id_col, tokens_col, minimum)
    reps, members = collapse_copies(sig)
    key_bytes = _key_bytes(reps)
    if key_bytes > PREFIX_JOIN_BYTES:  # the same pairs either way
        blocks = written_blocks(reps, key_threshold, threshold, block_size(key_bytes // 8))
        found = block_candidates(reps, key_threshold, threshold, blocks=blocks)
        pairs = reliable_checkpoint(found.select(F.least("x", "y").alias("id1"), F.greatest("x", "y").alias("id2"),
                                                 "jaccard", "key_jaccard"))
        release(blocks)
    else:
        cands = candidate_pairs(reps, key_threshold, threshold)
        if key_bytes > broadcast_bytes:  # token arrays are shuffled
            cands = difference_filter(cands, reps, key_threshold, threshold, broadcast_bytes=broadcast_bytes)
        pairs = verify_pairs(cands, reps, key_threshold, threshold, broadcast_bytes).persist(StorageLevel.MEMORY_AND_DISK)
    return NearDuplicates(pairs, members, reps)


def near_duplicate_pairs(docs: DataFrame, id_col: str = "id", tokens_col: str = "tokens",
                         key_threshold: float = 0.5, threshold: float = 0.5,
                         minimum: int = MIN_TOKENS) -> DataFrame:
    """JN1: the flat pair list (id1, id2, jaccard, key_jaccard), id1 < id2."""
    return near_duplicates(docs, id_col, tokens_col, key_threshold, threshold, minimum).all_pairs()


def pairs_by_project(found: NearDuplicates, projects: DataFrame, id_col: str = "id",
                     project_col: str = "project") -> DataFrame:
    """JN4: (scope, pairs): how many similar pairs lie within one project and across two.

    No pair of documents is built.  Each distinct bag has a histogram of its
    copies' projects; a pair of similar bags stands for the product of their
    copy counts, those within a project for the sum of products by project,
    and a bag's own copies for g (g - 1) / 2.  A null project is no project.
    """
    of = projects.select(F.col(id_col).alias("id"), F.col(project_col).alias("project"))
    histogram = (found.members.join(of, "id").groupBy("rep", "project").agg(F.count(F.lit(1)).alias("c"))
                 .persist(StorageLevel.MEMORY_AND_DISK))
    sizes = histogram.groupBy("rep").agg(F.sum("c").alias("g"))
    known = histogram.where(F.col("project").isNotNull())
    ends = [("id1", "1"), ("id2", "2")]
    side = lambda df, value, end, n: df.select(
        F.col("rep").alias(end), *[F.col(c) for c in df.columns if c not in ("rep", value)], F.col(value).alias(value + n))
    pairs = found.rep_pairs.select("id1", "id2")
    every, within = pairs, pairs
    for end, n in ends:
        every = every.join(side(sizes, "g", end, n), end)
        within = within.join(side(known, "c", end, n), [end] if n == "1" else [end, "project"])
    own = lambda c: F.floor(F.col(c) * (F.col(c) - 1) / 2)
    total = lambda df, what, sign: df.agg(F.coalesce(F.sum(what), F.lit(0)).cast("long").alias("n")).select(
        "n", F.lit(sign).alias("inside"))
    counts = (total(every, F.col("g1") * F.col("g2"), False).unionByName(total(sizes, own("g"), False))
              .unionByName(total(within, F.col("c1") * F.col("c2"), True)).unionByName(total(known, own("c"), True)))
    inside = F.sum(F.when(F.col("inside"), F.col("n")))
    return (counts.agg(F.array(F.struct(F.lit("within").alias("scope"), inside.alias("pairs")),
                               F.struct(F.lit("across").alias("scope"), (F.sum(F.when(~F.col("inside"), F.col("n"))) - inside).alias("pairs"))
                               ).alias("rows"))
            .select(F.explode("rows").alias("r")).select("r.*").where("pairs > 0"))


def key_jaccard(a, b):
    """JN2 on two token-set columns (array<string>)."""
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(inter / union)


def multiset_jaccard(bag_a, bag_b):
    """JN3 on two bag columns map<token, count>; 0 when both are empty."""
    mins = F.aggregate(F.map_values(F.map_zip_with(bag_a, bag_b, lambda _k, v1, v2: F.least(
        F.coalesce(v1, F.lit(0)), F.coalesce(v2, F.lit(0))))), F.lit(0).cast("long"), lambda acc, v: acc + v)
    maxs = F.aggregate(F.map_values(F.map_zip_with(bag_a, bag_b, lambda _k, v1, v2: F.greatest(
        F.coalesce(v1, F.lit(0)), F.coalesce(v2, F.lit(0))))), F.lit(0).cast("long"), lambda acc, v: acc + v)
    return F.when(maxs == 0, F.lit(0.0)).otherwise(mins / maxs)
