"""SimHash near-duplicates with pigeonring filtering (operator 10).

A fingerprint has one bit per place, set where more than half of the shingle hashes have it set. Two
fingerprints are linked at ``DISTANCE`` = 3 or fewer differing bits. Candidates come from the pigeonring
principle: with the 64 bits as a ring of 8 segments, two linked fingerprints have a segment from which every
chain of k consecutive segments differs in at most 3k/8 bits. So the first two segments are equal and the
first five differ in one bit at most, that is, at least two of the third to fifth are equal too. Every start
with every choice of these gives a mask of 32 bits: fingerprints that agree under one of the 24 masks are
candidates. The longer chains (at most two bits in six or seven segments) are tested next, then the full
distance.

Only distinct fingerprints are compared, so copies cost nothing. A bucket of more than ``BUCKET``
fingerprints is not compared pair by pair: the same principle is applied again to the bits that its mask
leaves free, which gives masks of 48 and then of 56 bits, where a bucket has 256 fingerprints at most. In a
small bucket only a spanning forest of the links is given out, so links grow with the fingerprints, not with
the pairs. This loses no connection: each link lies in a bucket at every level.

Components come from rounds of large and small stars over the links, each round stored in the shared folder.

Defined cases: a null or wordless text has fingerprint zero, linked like any other; fewer than three words
are one shingle; repeated rows give repeated results; rows with a null id get the smallest id of their
component, or null where it has none; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .frames import id_and_text, map_arrow, settle, texts_as_bytes

WORDS, DISTANCE, SEGMENTS, SEED = 3, 3, 8, 42
#: Largest bucket whose fingerprints are compared with each other, but at the last level.
BUCKET = 32
#: Hashes whose bits are added up at once.
_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The fingerprint of UTF-8 bytes; A-Z are lower-cased."""
    import xxhash

    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.array([len(t) for t in tokens], dtype=np.int64) + 1
    starts = np.cumsum(lengths) - lengths
    ends = starts + lengths - 1
    if len(tokens) < words:
        pairs = [(0, len(joined))]
    else:
        pairs = zip(starts[:len(tokens) - words + 1].tolist(), ends[words - 1:].tolist())
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
    total = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), _AT_ONCE):
        part = hashes[k:k + _AT_ONCE]
        total += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id, print``: the fingerprint as a signed long."""
    docs = id_and_text(docs, id_col, text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            prints = np.array([fingerprint(t or b"", words) for t in texts_as_bytes(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])
    return map_arrow(docs, work, f"doc_id {kind}, print bigint")


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def chain_masks(free: list[int]) -> list[dict]:
    """Pigeonring masks over the bit places ``free``, as a ring of ``SEGMENTS`` segments.

    Each has the places that must agree, and those of the chains of six and seven segments, in which at
    most two may differ.
    """
    width = len(free) // SEGMENTS
    bits = [sum(1 << p for p in free[s * width:(s + 1) * width]) for s in range(SEGMENTS)]
    found = []
    for start in range(SEGMENTS):
        ring = [bits[(start + k) % SEGMENTS] for k in range(SEGMENTS)]
        for loose in (2, 3, 4):
            found.append({"same": sum(ring[:5]) - ring[loose], "five": sum(ring[:5]), "six": sum(ring[:6]),
                          "seven": sum(ring[:7])})
    return found


def levels() -> list[list[tuple[int, int, int, int, int]]]:
    """Per level: (mask of the level above, mask, chains of five, six and seven segments)."""
    out, above = [], [0]
    for _ in range(3):
        level = []
        for parent in above:
            free = [p for p in range(64) if not parent >> p & 1]
            level += [(parent, parent | m["same"], parent | m["five"], parent | m["six"], parent | m["seven"])
                      for m in chain_masks(free)]
        out.append(level)
        above = sorted({m[1] for m in level})
    return out


def _forest(chains: dict[int, list[tuple[int, int, int]]]):
    """Spanning links of each bucket: ``chains`` has the longer chains of each mask."""
    def work(batches):
        for batch in batches:
            a, b = [], []
            for mask, prints in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                members = np.array(prints, dtype=np.int64).view(np.uint64)
                todo = np.arange(1, len(members))
                front = [0]
                # breadth first: each fingerprint is reached by one link from those reached before
                while len(todo):
                    if not front:
                        front, todo = [int(todo[0])], todo[1:]
                        continue
                    at = front.pop()
                    differ = members[todo] ^ members[at]
                    near = np.zeros(len(todo), dtype=bool)
                    for five, six, seven in chains[mask]:
                        near |= ((np.bitwise_count(differ & np.uint64(five)) <= 1)
                                 & (np.bitwise_count(differ & np.uint64(six)) <= 2)
                                 & (np.bitwise_count(differ & np.uint64(seven)) <= 2))
                    near &= np.bitwise_count(differ) <= DISTANCE
                    reached = todo[near]
                    a += [prints[at]] * len(reached)
                    b += [prints[i] for i in reached.tolist()]
                    front += reached.tolist()
                    todo = todo[~near]
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return work


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links between the distinct fingerprints in ``print`` that connect all that are near."""
    spark = prints.sparkSession
    found = None
    keys = prints.select("print")
    for level, masks in enumerate(levels()):
        children: dict[int, list] = {}
        chains: dict[int, list] = {}
        for parent, mask, *rest in masks:
            children.setdefault(parent, []).append(signed(mask))
            chains.setdefault(signed(mask), []).append(tuple(rest))
        if not level:
            masked = keys.withColumn("masks", F.array(*[F.lit(m).cast("bigint") for m in sorted(set(children[0]))]))
        else:  # at most 24 x 24 rows: the masks follow from the rule, not from the data
            table = spark.createDataFrame([(signed(p), sorted(set(m))) for p, m in children.items()],
                                          "mask bigint, masks array<bigint>")
            masked = keys.join(F.broadcast(table), "mask")
        keys = masked.select(F.explode("masks").alias("mask"), "print").select(
            "mask", F.col("print").bitwiseAND(F.col("mask")).alias("value"), "print")
        if level:
            keys = keys.distinct()
        size = keys.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        shared = settle(keys.join(size, ["mask", "value"]), f"simhash-level{level}")
        last = level == 2
        small = shared if last else shared.where(F.col("n") <= bucket)
        # a bucket has at most ``bucket`` fingerprints here, 256 at the last level
        groups = small.groupBy("mask", "value").agg(F.sort_array(F.collect_list("print")).alias("prints"))
        edges = map_arrow(groups.select("mask", "prints"), _forest(chains), "a bigint, b bigint")
        found = edges if found is None else found.unionByName(edges)
        keys = shared.where(F.col("n") > bucket).select("mask", "print")
        if last or keys.isEmpty():
            break
    return found.distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root``: every node of ``a, b`` links with the smallest node of its component.

    A large star links each node's greater neighbours to its smallest one, a small star its smaller ones;
    rounds go on until the links no longer change.
    """
    def smallest(pairs):
        return pairs.groupBy("u").agg(F.min("v").alias("least"))

    now = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v"), "links")
    mark = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = smallest(both).select("u", F.least("u", "least").alias("least"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        large = settle(large.where("u != v"), "large-star")
        least = smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u != v")
        now = settle(small.unionByName(least.select("u", F.col("least").alias("v"))).distinct(), "small-star")
        # a sum of hashes tells whether the set of links is still the same
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _prints_and_names(docs: DataFrame, id_col: str, text_col: str, bucket: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, print) of every row and (print, component_id) of every distinct fingerprint."""
    prints = settle(fingerprints(docs, id_col=id_col, text_col=text_col), "prints")
    owners = settle(prints.groupBy("print").agg(F.min("doc_id").alias("least_id")), "owners")
    roots = components(links(owners.select("print"), bucket)).withColumnRenamed("node", "print")
    rooted = owners.join(roots, "print").select("print", "root", "least_id")
    named = rooted.select("print", "root").join(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "root")
    names = owners.join(named.select("print", "component_id"), "print", "left").select(
        "print", F.coalesce("component_id", "least_id").alias("component_id"))
    # stored, so that both sides of a join with it come from exchanges of their own and a very frequent print can be split
    return prints, settle(names, "names")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``doc_id, print, component_id``: the smallest id reachable over links."""
    prints, names = _prints_and_names(docs, id_col, text_col, bucket)
    return prints.join(names, "print").select("doc_id", "print", "component_id")


def as_hex(column):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of ``docs`` with the smallest id of their component, with all their columns.

    Rows that repeat such an id are the same document and stay together; rows with a null id stay only
    where their whole component has no id.
    """
    prints, names = _prints_and_names(docs, id_col, text_col, BUCKET)
    ids = prints.join(names, "print").where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    kept = docs.join(ids, docs[id_col] == ids["__kept"], "left_semi")
    unnamed, place = docs.where(F.col(id_col).isNull()), docs.columns.index(text_col)

    def with_print(batches):
        for batch in batches:
            own = np.array([fingerprint(t or b"") for t in texts_as_bytes(batch.column(place))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.view(np.int64))], names=[*batch.schema.names, "__print"])
    schema = StructType([*docs.schema.fields, StructField("__print", LongType())])
    alone = names.where("component_id is null").select(F.col("print").alias("__print"))
    return kept.unionByName(map_arrow(unnamed, with_print, schema).join(alone, "__print", "left_semi").drop("__print"))
