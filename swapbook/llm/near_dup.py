"""MinHash near-duplicates by HyperMinHash sketches.

A text is the set of its distinct 5-word shingles. Each shingle's 64-bit hash picks one of 128 buckets by its first
7 bits; a bucket's register holds the number of leading zeros of the least remaining value and the 10 bits after its
first one. Four neighbouring registers make a band, and texts with an equal band are candidates. A candidate pair's
registers give an estimate of the Jaccard similarity, corrected for registers that agree by chance; pairs that
are clearly below the threshold by it are dropped, the others are compared on their full sets.

A true pair at the threshold of 0.75 differs in all 32 bands with a chance of about 5 in a million.

Equal texts become one node first, however many there are. In a band's bucket all nodes are compared with the
least one (the hub), and those that stay apart from it with a few other hubs; that is linear in the bucket and joins
large groups of near copies. What is left to compare are nodes of one bucket that lie in different components. In buckets of bounded size their pairs are formed by a join
whose condition holds the estimate; the nodes of larger ones are brought together by an exact prefix filter on their
sets, in which a passage that many texts share brings nobody together, and parity bits rule out most of the rest. Sets are built only for nodes that share a bucket with another.

Defined cases: a text without words has no shingles and links with nothing; with fewer than five words, the whole
sequence is the one shingle; rows with one doc_id are one node and share their links; a null doc_id takes no part
(its component is null and it is kept); other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swapbook.llm.components import components
from swapbook.llm.store import bucketed, kept
from swapbook.llm.text import ascii_lower, hashed, whole, windows, words

SHINGLE = 5
PERCENT = 75
BUCKET_BITS = 7
BAND_BITS = 5
MANTISSA_BITS = 10
REST_BITS = 64 - BUCKET_BITS
#: Expected chance agreements of two unrelated sketches over 2 ** (bucket bits - mantissa bits), for sets of equal size.
CHANCE = 0.1699194871597391
#: Standard deviations that an estimate may lie below the threshold.
SLACK = 5.0
#: Further hubs per bucket.
HUBS = 6
#: Nodes of a bucket up to which its open pairs are formed directly; larger buckets go by prefixes.
DIRECT = 64
#: 64-bit words of the parity bits.
PARITY_WORDS = 8
#: Counters of shingles, a power of two: more make the order by frequency finer, at a byte each in every task.
COUNTERS = 1 << 21


def shingles(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_key`` (digest of the word sequence, null without words) and ``_set`` (sorted distinct shingle hashes)."""
    found = df.withColumn("_words", words(ascii_lower(whole(F.col(text)))))
    digest = F.when(F.size("_words") > 0, F.md5(F.array_join("_words", " ")))
    found = found.withColumns({"_key": digest, "_hashes": hashed(F.col("_words")), "_first": F.xxhash64("_words")})
    short = F.size("_hashes") < SHINGLE
    found = found.withColumn("_runs", F.when(short & (F.size("_hashes") > 0), F.array("_first")).otherwise(windows(F.col("_hashes"), SHINGLE)))
    return found.withColumn("_set", F.sort_array(F.array_distinct("_runs"))).drop("_words", "_hashes", "_runs", "_first")


def registers(sorted_hashes: Column) -> Column:
    """The filled registers as numbers that hold bucket, leading zeros and mantissa.

    In sorted order the hashes of a bucket are neighbours, and its first one is its least.
    """

    def bucket(h: Column) -> Column:
        return F.shiftright(h, REST_BITS)

    def leads(h: Column, i: Column) -> Column:
        return (i == 0) | (bucket(h) != bucket(F.get(sorted_hashes, i - 1)))

    def register(h: Column) -> Column:
        rest = h.bitwiseAND(F.lit((1 << REST_BITS) - 1))
        bits = F.length(F.bin(rest))
        shift = F.greatest(bits - (MANTISSA_BITS + 1), F.lit(0))
        mantissa = F.call_function("shiftright", rest, shift).bitwiseAND(F.lit((1 << MANTISSA_BITS) - 1))
        slot = bucket(h) + F.lit(1 << (BUCKET_BITS - 1))
        zeros = F.lit(REST_BITS) - bits
        return (slot * (1 << 16) + zeros * (1 << MANTISSA_BITS) + mantissa).cast("int")

    return F.transform(F.filter(sorted_hashes, leads), register)


def slot_of(code: Column) -> Column:
    return F.shiftright(code, 16)


def bands(codes: Column) -> Column:
    """A hash of each band's registers; bands without any have none."""
    per_band = 1 << (BUCKET_BITS - BAND_BITS)
    numbers = F.array_distinct(F.transform(codes, lambda c: F.floor(slot_of(c) / per_band).cast("int")))
    return F.transform(
        numbers, lambda b: F.xxhash64(b, F.filter(codes, lambda c: F.floor(slot_of(c) / per_band).cast("int") == b))
    )


def estimate(a: Column, b: Column, n_a: Column, n_b: Column) -> tuple[Column, Column]:
    """Jaccard similarity of two sketches, and the number of registers filled in either."""
    filled = F.size(F.array_union(F.transform(a, slot_of), F.transform(b, slot_of))).cast("double")
    alike = F.size(F.array_intersect(a, b)).cast("double")
    balance = 4.0 * n_a * n_b / ((n_a + n_b) * (n_a + n_b))
    chance = F.lit(CHANCE * 2.0 ** (BUCKET_BITS - MANTISSA_BITS)) * balance
    return F.greatest(alike - chance, F.lit(0.0)) / filled, filled


def plausible(a: str, b: str) -> Column:
    """Neither sizes nor sketches of ``a`` and ``b`` (prefixes of n and codes) rule the threshold out."""
    n_a, n_b = F.col(f"{a}n"), F.col(f"{b}n")
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT
    codes = F.col(f"{a}codes"), F.col(f"{b}codes")
    share = PERCENT / 100

    def limit(filled: Column) -> Column:
        return F.lit(share) - F.sqrt(F.lit(share * (1 - share)) / filled) * SLACK

    # with the larger sketch for the union of both the estimate can only be higher; that settles most pairs
    most = F.greatest(F.size(codes[0]), F.size(codes[1])).cast("double")
    quick = F.size(F.array_intersect(*codes)) / most >= limit(F.least(most * 2, F.lit(float(1 << BUCKET_BITS)))) - 0.01
    similarity, filled = estimate(*codes, n_a, n_b)
    return sizes & quick & (similarity >= limit(filled))


def parities(items: Column) -> Column:
    """Bits that each item of a set flips one of: two sets differ in at least as many items as bits."""

    def word(k: Column) -> Column:
        own = F.filter(items, lambda h: F.shiftright(h, 6).bitwiseAND(F.lit(PARITY_WORDS - 1)) == k)
        flipped = F.transform(own, lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int")))
        return F.aggregate(flipped, F.lit(0).cast("long"), lambda a, bit: a.bitwiseXOR(bit))

    return F.transform(F.sequence(F.lit(0), F.lit(PARITY_WORDS - 1)), word)


def sketched(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, key, n, codes) of each document."""
    found = shingles(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text")), "_text")
    return found.select(
        "doc_id", F.col("_key").alias("key"), F.size("_set").cast("long").alias("n"), registers(F.col("_set")).alias("codes")
    )


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("_a"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("_a", "_b")).cast("long")
    united = F.size("_a").cast("long") + F.size("_b").cast("long") - F.col("_common")
    return both.withColumn("_common", common).filter(F.col("_common") * 100 >= united * PERCENT).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept (the least id of its component) of each document."""
    base = kept(sketched(docs, id_col, text))
    classes = base.filter("key is not null and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("node"))
    sketches = base.join(classes, (base.key == classes.key) & (base.doc_id == classes.node), "left_semi")
    sketches = sketches.select(F.col("doc_id").alias("node"), "n", "codes").dropDuplicates(["node", "n"])
    sketches = kept(sketches.withColumn("bands", bands(F.col("codes"))))

    placed = sketches.select("node", F.explode("bands").alias("bucket"))
    hubs = placed.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("_max")).filter("hub <> _max")
    shared = kept(placed.join(hubs.select("bucket", "hub"), "bucket"))
    members = shared.select("node").distinct()
    wanted = docs.select(F.col(id_col).alias("node"), F.col(text).alias("_text")).join(members, "node", "left_semi")
    own = shingles(wanted, "_text").select("node", F.col("_set").alias("items")).dropDuplicates(["node"])
    with bucketed(own, "node") as sets:
        labels = _linked(sketches, shared, sets)

    owners = classes.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component_id"))
    # rows with one doc_id are one node, so the component is looked up by the text and then lowered by the id
    found = base.join(owners, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    found = found.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _linked(sketches: DataFrame, shared: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, component) of each node that is linked with another."""
    a, b = _prefixed(sketches, "a"), _prefixed(sketches, "b")
    spokes = shared.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    near = spokes.join(a, "a").join(b, "b").filter(plausible("a_", "b_")).select("a", "b")
    links = kept(confirmed(near, sets))

    labels = components(links)
    hubs_found = confirmed(_by_hubs(shared, labels, sketches), sets)
    links = kept(_stars(labels).unionByName(hubs_found))
    labels = components(links)
    mixed = kept(_mixed(shared, labels))
    rest = _by_pairs(mixed.filter(F.col("_size") <= DIRECT), sketches)
    rest = rest.unionByName(_by_prefixes(mixed.filter(F.col("_size") > DIRECT).select("node", "component").distinct(), sets))
    links = kept(_stars(labels).unionByName(confirmed(rest.distinct(), sets)))
    return components(links)


def _stars(labels: DataFrame) -> DataFrame:
    """Links that keep what is known: each node and the root of its component."""
    return labels.select(F.col("node").alias("a"), F.col("component").alias("b"))


def _mixed(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, component, _size): the buckets whose nodes do not all lie in one component."""
    named = shared.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    sizes = named.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("_size"), F.min("component").alias("_lo"), F.max("component").alias("_hi")
    )
    return named.join(sizes.filter("_lo <> _hi").select("bucket", "_size"), "bucket")


def _sides(rows: DataFrame, sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    full = rows.join(sketches, "node")
    fields = ("node", "component", "n", "codes")
    return tuple(full.select("bucket", *[F.col(c).alias(f"{side}_{c}") for c in fields]) for side in "ab")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def _by_hubs(shared: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """Plausible pairs of a few nodes per bucket, picked by a hash, with those of other components."""
    x, y = _sides(_mixed(shared, labels), sketches)
    picks = [F.min(F.struct(F.xxhash64(F.lit(k), "a_node").alias("h"), "a_node")).alias(f"h{k}") for k in range(HUBS)]
    nodes = F.array_distinct(F.array(*[f"h{k}.a_node" for k in range(HUBS)]))
    chosen = x.groupBy("bucket").agg(*picks).select("bucket", F.explode(nodes).alias("a_node"))
    x = x.join(chosen, ["bucket", "a_node"], "left_semi")
    return _ordered(x.join(y, (x.bucket == y.bucket) & (x.a_component != y.b_component) & plausible("a_", "b_")))


def _by_pairs(mixed: DataFrame, sketches: DataFrame) -> DataFrame:
    """Plausible pairs of different components within buckets of bounded size."""
    x, y = _sides(mixed, sketches)
    return _ordered(x.join(y, (x.bucket == y.bucket) & (x.a_node < y.b_node) & (x.a_component != y.b_component) & plausible("a_", "b_")))


def _levels(sets: DataFrame) -> np.ndarray:
    """How frequent the shingles of each counter are over all ``items``, in eighths of an octave; 0 for at most one.

    A counter counts every shingle with its low bits, so one of level 0 belongs to a single set.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy() & (COUNTERS - 1), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["place", "n"])

    counts = sets.select("items").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).filter("n > 1")
    level = F.least(F.ceil(F.log2("n") * 8), F.lit(255)).cast("int")
    found = counts.select("place", level.alias("level")).toArrow()  # a row per counter at most
    levels = np.zeros(COUNTERS, np.uint8)
    levels[found["place"].to_numpy()] = found["level"].to_numpy()
    return levels


def _posted(full: DataFrame, levels: np.ndarray) -> DataFrame:
    """(item, node, component, n, before) of the shingles in the prefix of each set that may be in another one, too.

    ``before`` is how many shingles of the set come before this one.
    """
    shared = full.sparkSession.sparkContext.broadcast(levels.tobytes())

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            node, component, sets = batch.columns
            n = sets.value_lengths().to_numpy().astype(np.int64)
            items, row = sets.flatten().to_numpy(), np.repeat(np.arange(len(n)), n)
            level = levels[items & (COUNTERS - 1)]
            order = np.lexsort((items, level, row))
            before = np.arange(len(items)) - np.repeat(np.cumsum(n) - n, n)
            length = n + n * -PERCENT // 100 + 1
            # shingles of level 0 come first and need no look
            at = np.flatnonzero((before < length[row]) & (level[order] > 0))
            row = row[at]
            columns = [pa.array(items[order[at]]), node.take(pa.array(row)), component.take(pa.array(row)), pa.array(n[row]), pa.array(before[at])]
            yield pa.RecordBatch.from_arrays(columns, ["item", "node", "component", "n", "before"])

    own = full.select("node", "component", "items")
    kinds = {f.name: f.dataType.simpleString() for f in own.schema}
    return own.mapInArrow(post, f"item long, node {kinds['node']}, component {kinds['component']}, n long, before long")


def _by_prefixes(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of different components among the nodes of large buckets, without forming the pairs of a bucket.

    With shingles ordered from rare to frequent, two sets that reach the threshold share one among the first
    n - ceil(0.75 n) + 1 of each. What many texts share comes last in that order, so it brings nobody together. Any order will
    do, so the frequencies are those of a bounded number of counters: no row is made for a shingle to look its own up.
    A pair is only wanted at the first shingle that both have: all they share then lies from there on in either order, so a
    pair with too little left in one of them is not formed there, and texts that are alike but apart seldom meet at all.
    """
    # sets lie in buckets, so the second look joins them again instead of keeping a copy
    full = kept(nodes).join(sets, "node")
    posted = kept(_posted(full, _levels(full)))
    open_ = posted.groupBy("item").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).filter("_lo <> _hi")
    rows = posted.join(open_.select("item"), "item", "left_semi").join(full.select("node", parities(F.col("items")).alias("bits")), "node")
    x, y = (rows.select("item", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "component", "n", "before", "bits")]) for side in "ab")
    # at most these can be common if this is the first one that is
    common = F.least(x.a_n - x.a_before, y.b_n - y.b_before)
    enough = common * (100 + PERCENT) >= (x.a_n + y.b_n) * PERCENT
    differing = sum((F.bit_count(F.get(x.a_bits, k).bitwiseXOR(F.get(y.b_bits, k))) for k in range(PARITY_WORDS)), F.lit(0))
    enough &= differing * (100 + PERCENT) <= (x.a_n + y.b_n) * (100 - PERCENT)
    return _ordered(x.join(y, (x.item == y.item) & (x.a_node < y.b_node) & (x.a_component != y.b_component) & enough))


def _prefixed(sketches: DataFrame, side: str) -> DataFrame:
    return sketches.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("codes").alias(f"{side}_codes"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are kept, one row for each id; rows without an id stay."""
    stays = near_duplicates(docs, id_col, text).filter("kept and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    own = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(id_col).alias("_id"))
    named = own.filter("_id is not null").join(stays, "_id")
    first = F.row_number().over(Window.partitionBy("_id").orderBy(F.lit(0)))
    single = named.withColumn("_no", first).filter("_no = 1").select("_doc.*")
    return single.unionByName(own.filter("_id is null").select("_doc.*"))
