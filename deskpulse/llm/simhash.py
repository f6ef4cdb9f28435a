"""SimHash near-duplicates by a self-join of binary tries."""

from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskpulse.llm.bit_trie import forest_of
from deskpulse.llm.common import checkpointed, column, fresh_name
from deskpulse.llm.components import components

BITS = 64
SHINGLE = 4
MAX_BITS = 4
# A group of codes that agree in a key is one trie up to this size; larger ones are
# cut into slices of half of it, and any two slices meet in a trie of their own.
GROUP = 4096
# Codes a Python worker takes at once (whole groups).
BATCH = 1 << 16
# Larger lists of oversized groups are joined, not broadcast.
BROADCAST_ROWS = 100_000


def simhash(text, shingle=SHINGLE):
    """Fingerprint of a text as an unsigned 64-bit number; see ``fingerprints``."""
    import xxhash

    words = (text or "").encode().lower().split()
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    ends = np.cumsum(lengths + 1) - 1
    first = (ends - lengths)[: max(1, n - shingle + 1)]
    last = ends[min(shingle, n) - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(first), BATCH):
        spans = zip(first[at : at + BATCH].tolist(), last[at : at + BATCH].tolist())
        hashes = np.array([digest(joined[i:j], 42) for i, j in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > len(first), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(documents, id_col="doc_id", text_col="text", shingle=SHINGLE):
    """(id_col, code): the SimHash of each row's whole text as a signed long.

    A-Z are lower-cased, words are split at ASCII white space, runs of ``shingle`` words
    (all words of a shorter text) are hashed with XXH64, seed 42, repeats included. A bit
    is set if it is set in more than half the hashes. A text without words, null
    included, has code 0.
    """
    source = documents.select(column(id_col).alias("id"), column(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            codes = [simhash(text.as_py(), shingle) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.array(codes, dtype=np.uint64).view(np.int64))],
                names=["id", "code"],
            )

    schema = T.StructType(
        [T.StructField("id", source.schema["id"].dataType), T.StructField("code", T.LongType())]
    )
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def key_masks(n_codes, max_bits=MAX_BITS):
    """Bit masks such that codes within ``max_bits`` agree under at least one of them.

    The 64 bits are cut into blocks; ``max_bits`` errors leave all but ``max_bits`` of
    them alone, so every choice of the others is a mask. The blocks become more, and the
    masks longer, as the codes grow in number: a key then has about 64 codes.
    """
    wanted = max(1.0, log2(max(2, n_codes)) - 6)
    blocks = max_bits + 1
    while blocks < BITS and blocks < max_bits + 4 and BITS * (blocks - max_bits) / blocks < wanted:
        blocks += 1
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), max(1, blocks - max_bits)):
        mask = 0
        for block in chosen:
            for bit in range(edges[block], edges[block + 1]):
                mask |= 1 << bit
        masks.append(mask)
    return masks


def _signed(value):
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _groups(codes, masks, group):
    """A row (mask, key, low, high, code) for each trie a code belongs to."""
    keyed = codes.select(
        "code",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("mask"), F.col("code").bitwiseAND(_signed(m)).alias("key")
                    )
                    for i, m in enumerate(masks)
                ]
            )
        ).alias("k"),
    ).select("code", "k.mask", "k.key")
    sizes = keyed.groupBy("mask", "key").count().where(F.col("count") > group)
    sizes = checkpointed(
        sizes.select("mask", "key", F.ceil(2 * F.col("count") / group).cast("int").alias("slices"))
    )
    if sizes.count() <= BROADCAST_ROWS:
        sizes = F.broadcast(sizes)
    cut = keyed.join(sizes, ["mask", "key"], "left").withColumn(
        "slice",
        F.when(F.col("slices").isNull(), 0).otherwise(
            F.pmod(F.xxhash64("code"), F.col("slices")).cast("int")
        ),
    )
    others = F.when(F.col("slices").isNull(), F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("slices") - 1), lambda s: s != F.col("slice"))
    )
    return cut.select("mask", "key", "code", "slice", F.explode(others).alias("other")).select(
        "mask",
        "key",
        F.least("slice", "other").alias("low"),
        F.greatest("slice", "other").alias("high"),
        "code",
    )


def links(codes, max_bits=MAX_BITS, group=GROUP):
    """Links (a, b) that connect all codes within ``max_bits`` of one another.

    ``codes`` has one column, ``code``, of distinct longs. Not every near pair is a row:
    each trie returns a spanning forest, so codes are connected exactly as by all near
    pairs, and a dense group gives as many rows as it has codes.
    """
    masks = key_masks(codes.count(), max_bits)
    tries = _groups(codes, masks, group)
    tries = tries.repartition("mask", "key", "low", "high").sortWithinPartitions(
        "mask", "key", "low", "high", "code"
    )
    everything = (1 << BITS) - 1

    def forests(table):
        columns = {n: table.column(n).to_numpy() for n in ("mask", "key", "low", "high")}
        code = table.column("code").to_numpy().view(np.uint64)
        change = np.zeros(len(code), dtype=bool)
        change[:1] = True
        for values in columns.values():
            change[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(change)
        for mask in np.unique(columns["mask"]):
            lo, hi = np.searchsorted(columns["mask"], [mask, mask + 1])
            own = starts[(starts >= lo) & (starts < hi)]
            # Spark sorts by sign, which matters only for codes of one group
            order = lo + np.lexsort((code[lo:hi], np.searchsorted(own, np.arange(lo, hi), "right")))
            part = code[order]
            free = everything & ~masks[mask]
            bits = [b for b in range(BITS - 1, -1, -1) if free >> b & 1]
            root = forest_of(part, own - lo, bits, max_bits)
            hung = np.flatnonzero(root != np.arange(len(part)))
            if len(hung):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[hung].view(np.int64)), pa.array(part[root[hung]].view(np.int64))],
                    names=["a", "b"],
                )

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < BATCH:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = [table.column(n).to_numpy() for n in ("mask", "key", "low", "high")]
            same = np.ones(rows, dtype=bool)
            for values in last:
                same &= values == values[-1]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield from forests(table.slice(0, cut))
            held, rows = table.slice(cut).to_batches(), table.num_rows - cut
        if rows:
            yield from forests(pa.Table.from_batches(held).combine_chunks())

    return tries.mapInArrow(run, "a long, b long")


def _coded(documents, id_col, text_col, shingle, max_bits, group):
    """The rows' codes, and the group (root code, least id) of each distinct code."""
    coded = checkpointed(fingerprints(documents, id_col, text_col, shingle))
    distinct = checkpointed(coded.groupBy("code").agg(F.min(column(id_col)).alias("least")))
    found = components(links(distinct.select("code"), max_bits, group))
    rooted = distinct.join(found, distinct["code"] == found["node"], "left").select(
        "code", F.coalesce("root", "code").alias("root"), "least"
    )
    rooted = checkpointed(rooted)
    members = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return coded, checkpointed(
        rooted.select("code", "root").join(members.repartition(parts), "root")
    )


def near_duplicates(
    documents, id_col="doc_id", text_col="text", shingle=SHINGLE, max_bits=MAX_BITS, group=GROUP
):
    """One row per document: id, ``fingerprint`` (16 hex digits), ``component_id``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked, and
    ``component_id`` is the smallest id reachable over links. Texts without words have
    fingerprint zero and link like any other. Repeated rows stay rows; a row without an
    id counts as a document and links, but a component of such rows alone has a null
    ``component_id``. An empty table gives no rows.
    """
    coded, grouped = _coded(documents, id_col, text_col, shingle, max_bits, group)
    return coded.join(grouped, "code").select(
        column(id_col),
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    documents, id_col="doc_id", text_col="text", shingle=SHINGLE, max_bits=MAX_BITS, group=GROUP
):
    """The documents without near copies: of each component the one with the least id.

    All columns stay. Of several rows with that id, or of a component without ids, the
    row with the least text stays (nulls first).
    """
    coded, grouped = _coded(documents, id_col, text_col, shingle, max_bits, group)
    ids = coded.groupBy(column(id_col).alias("id")).agg(F.count("*").alias("rows"))
    plain = checkpointed(ids.where("id is not null and rows = 1").select("id"))
    chosen = grouped.select("root", "component_id").distinct()
    name = fresh_name(documents.columns, "kept")
    single = chosen.join(plain, chosen["component_id"] == plain["id"], "left_semi")
    single = single.select(F.col("component_id").alias(name))
    single = documents.join(single, column(id_col) == F.col(name), "left_semi")
    odd = checkpointed(ids.where("id is null or rows > 1").select("id"))
    if odd.isEmpty():
        return single
    return single.unionByName(_of_odd(documents, odd, grouped, id_col, text_col, shingle))


def _of_odd(documents, odd, grouped, id_col, text_col, shingle):
    """One row of each component whose least id is missing or repeated."""
    whole = F.struct(*[column(c) for c in documents.columns])
    rows = documents.select(
        whole.alias("row"), column(id_col).alias("id"), column(text_col).alias("text")
    )
    odd = odd.withColumnRenamed("id", "odd")
    rows = rows.join(odd, F.col("id").eqNullSafe(F.col("odd")), "left_semi")
    numbered = checkpointed(rows.withColumn("at", F.monotonically_increasing_id()))
    codes = fingerprints(numbered, "at", "text", shingle)
    placed = numbered.join(codes, "at").join(grouped, "code")
    placed = placed.where(F.col("id").eqNullSafe(F.col("component_id")))
    first = placed.groupBy("root").agg(F.min_by("at", F.struct("text", "at")).alias("at"))
    return numbered.join(first, "at", "left_semi").select("row.*")
