"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most two bits have a common neighbour within one bit of both. So each distinct
fingerprint is sent under all 65 values of its radius-1 ball; those that meet under one value are within two bits of
each other. Only distinct fingerprints travel, a value's group has at most 65 members whatever the input, and each
member is linked to the smallest of its group, which keeps every component whole without emitting all pairs.

Near duplicates of a stated similarity (``similar_classes``) are joined first where fingerprints of fewer bits are equal,
which brings large groups of near copies together. Whatever pair is left then meets by signatures that similar sets must
share, and every pair of members that are not known to be of one class is verified by its exact shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.components import connected
from citeloom.llm.textops import Scratch, lean, materialise, mix, small_batches

RADIUS = 2


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned 64-bit SimHash of the ASCII-lower-cased text's word shingles, repeats included; 0 without words."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    n = len(parts) - words + 1
    if n < 2:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[words - 1 :].tolist())], np.uint64, n)
    ones = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 14):
        ones += np.unpackbits(h[a : a + (1 << 14)].view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            found = np.array([fingerprint(t, words) for t in b.column(b.schema.get_field_index("text")).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id long, fp long (the fingerprint's bits), one row per row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprints(words), "doc_id long, fp long")


def ball_links(prints: DataFrame) -> DataFrame:
    """Links (u, v) between distinct fingerprints of column fp that differ in one or two bits, enough to connect all such pairs."""
    fp = F.col("fp")
    ball = F.array(fp, *[fp.bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")) for b in range(64)])
    met = prints.select("fp", F.explode(ball).alias("value")).withColumn("low", F.min("fp").over(Window.partitionBy("value")))
    pairs = met.where("low < fp").select(F.col("fp").alias("u"), F.col("low").alias("v")).distinct()
    return pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS)


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable over links of at most 2 bits.

    One row per input row. Null, empty and wordless texts share the fingerprint zero and are linked like any other.
    Null ids never become a component's id, unless it has no other; repeated ids keep their rows. Extra columns are ignored.
    """
    prints = materialise(fingerprints(docs, words), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected(ball_links(distinct.select("fp")))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("fp", "root").join(best, "root").select("fp", "component_id")
    out = prints.join(classes, "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# ---- near duplicates of a stated similarity ----------------------------------------------------------------------

#: Odd multipliers that turn one shingle hash into independent ones, 64 bits each.
_SPREAD = [0x9E3779B97F4A7C15 + 2 * i * 0xBF58476D1CE4E5B9 & (2**64 - 1) | 1 for i in range(16)]


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles (ASCII case folded)."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    ends = (np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    tail = ends[words - 1 :] or ends[-1:]
    return np.unique(np.fromiter([digest(joined[a:b], 42) for a, b in zip(starts[:n], tail)], np.uint64, n))


def sketch(shingles: np.ndarray, bits: int) -> np.ndarray:
    """The first ``bits`` bits (0/1) of a SimHash over distinct shingles, all of them of weight one."""
    count = np.zeros(-(-bits // 64) * 64, np.int64)
    with np.errstate(over="ignore"):
        for j in range(len(count) // 64):
            h = mix(shingles * np.uint64(_SPREAD[j]))
            for a in range(0, len(h), 255 * 64):
                part = np.unpackbits(h[a : a + 255 * 64].view(np.uint8)).reshape(-1, 64)
                for b in range(0, len(part), 255):
                    count[64 * j : 64 * j + 64] += np.add.reduce(part[b : b + 255], axis=0, dtype=np.uint8)
    return (2 * count[:bits] > len(shingles)).astype(np.uint8)


_MADE = "id long, folded binary, bases array<long>, mark array<long>, signatures array<long>"
#: Bits of a set's parity bitmap, in longs. Two sets differ in as many elements as their bitmaps in bits, or more.
_PARITY = 8


def _sizes(least: float, most: int) -> list[int]:
    """Largest sizes of the size classes, from class 0 (empty sets) on, until the last but one holds ``most``.

    A set of class c is similar to none that is larger than those of class c + 1.
    """
    tops = [0, 1]
    while tops[-2] < most:
        tops.append(max(tops[-1] + 1, int(tops[-1] / least + 1e-6)))
    return tops


def signatures(shingles: np.ndarray, least: float, tops: list[int]) -> np.ndarray:
    """Hashes of parts of a set (sorted, distinct), so chosen that sets of Jaccard similarity ``least`` or more share one.

    Two such sets differ in at most d = (|A| + |B|)(1 - least)/(1 + least) elements. The range of the hashes is cut into m > d
    parts, the same for all sets of one size class and for those of the class below as their smaller mates. Then at least
    m - d parts are equal in both, so the first d + 1 parts of each in any common order have one in common. The order is by
    the number of elements, larger first, so that what is shared are several elements spread over the set.
    """
    n, gap = len(shingles), (1 - least) / (1 + least)
    if not n:
        return np.zeros(0, np.uint64)
    own, out = int(np.searchsorted(tops, n)), []
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum(mix(shingles * np.uint64(_SPREAD[1])), dtype=np.uint64)]
        for c in (own, own + 1):
            mate = min(tops[c], int(n / least + 1e-6))
            if c > own and mate <= tops[own]:
                continue
            parts = int(2 * tops[c] * gap + 1e-6) + 1
            parts = parts if parts == 1 else -(-6 * parts // 5)  # beyond d + 1, the smallest of the parts are left out
            at = ((shingles >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            size = np.bincount(at, minlength=parts)
            ends = np.cumsum(size)
            value = mix(sums[ends] - sums[ends - size] + np.arange(parts, dtype=np.uint64) * np.uint64(_SPREAD[2]) + np.uint64(c) * np.uint64(_SPREAD[3]))
            out.append(value[np.lexsort((value, -size))[: int((n + mate) * gap + 1e-6) + 1]])
    return np.unique(np.concatenate(out))


def _mark(shingles: np.ndarray) -> np.ndarray:
    """The set's size and parity bitmap."""
    odd = np.bincount((shingles & np.uint64(64 * _PARITY - 1)).astype(np.int64), minlength=64 * _PARITY) & 1
    return np.r_[len(shingles), np.packbits(odd.astype(np.uint8)).view(np.int64)]


def _sketches(words: int, least: float, tables: int, bits: int) -> Callable:
    place = (1 << np.arange(bits, dtype=np.int64))[::-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [0, 1]
        for b in small_batches(batches):
            folded, lists = [], ([], [], [])
            for t in b.column(b.schema.get_field_index("text")).to_pylist():
                shingles = shingle_set(t, words)
                if tops[-2] < len(shingles):
                    tops = _sizes(least, 2 * len(shingles))
                folded.append(xxhash.xxh3_128_digest(b" ".join((t or "").encode().lower().split())))
                made = sketch(shingles, tables * bits).reshape(tables, bits) @ place + (np.arange(tables, dtype=np.int64) << bits)
                for kept, x in zip(lists, (made, _mark(shingles), signatures(shingles, least, tops).view(np.int64))):
                    kept.append(x)
            ends = [np.cumsum([0, *map(len, x)]).astype(np.int32) for x in lists]
            arrays = [pa.ListArray.from_arrays(pa.array(e), pa.array(np.concatenate(x), pa.int64())) for e, x in zip(ends, lists)]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("id")), pa.array(folded, pa.binary()), *arrays], ["id", "folded", "bases", "mark", "signatures"])

    return run


def _sets(words: int) -> Callable:
    """The six high bytes of each shingle hash, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            sets = [shingle_set(t, words).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("id")), pa.array(sets, pa.binary())], ["id", "shingles"])

    return run


def _hashes(packed: pa.Scalar) -> np.ndarray:
    out = np.zeros((len(packed.as_buffer()) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(packed.as_buffer(), np.uint8).reshape(-1, 6)
    return out.reshape(-1).view(">u8").astype(np.uint64)


def _agree(least: float) -> Callable:
    """Links (u, v) of rows (key, id, mates, shingles) in order of key: members of one key that are listed as mates and
    whose shingle sets have a Jaccard similarity of at least ``least``; of pairs connected within a key, only as many as connect them."""

    def links(ids: list[int], mates: list[list[int]], sets: list[pa.Scalar]) -> list[tuple[int, int]]:
        packed, root, made, out = dict(zip(ids, sets)), {i: i for i in ids}, {}, []

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        def hashes(i: int) -> np.ndarray:
            if i not in made:
                made[i] = _hashes(packed[i])
            return made[i]

        size = {i: len(x.as_buffer()) // 6 for i, x in packed.items()}
        for u, near in zip(ids, mates):
            for v in near:
                fewer, more = sorted((size[u], size[v]))
                if fewer < least * more or top(u) == top(v):
                    continue
                both = len(np.intersect1d(hashes(u), hashes(v), assume_unique=True))
                if both >= least * max(1, fewer + more - both):
                    root[max(top(u), top(v))] = min(top(u), top(v))
                    out.append((u, v))
        return out

    def table(out: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids, mates, sets = None, [], [], []
        for b in batches:
            out = []
            for key, i, near, own in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("key", "id", "mates")), b.column(b.schema.get_field_index("shingles"))):
                if key != last:
                    out += links(ids, mates, sets)
                    last, ids, mates, sets = key, [], [], []
                ids.append(i)
                mates.append(near)
                sets.append(own)
            yield table(out)
        yield table(links(ids, mates, sets))

    return run


def _maybe(docs: DataFrame, wanted: DataFrame, most_bits: int = 1 << 27) -> DataFrame:
    """``docs`` with a column _maybe: true where the id is in ``wanted`` (id, repeats allowed), and for about one in 70 of the others.

    The ids are two bits each of one broadcast row, of 16 bits an id and ``most_bits`` at most, so that no row of ``docs`` is shuffled.
    """
    n = min(most_bits, 1 << max(10, (16 * wanted.count()).bit_length()))
    h = F.xxhash64("id")
    at = F.array(h.bitwiseAND(F.lit(n - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(n - 1)))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    set_bits = wanted.distinct().select(F.explode(at).alias("at")).select(F.shiftright("at", 6).alias("word"), bit.alias("bits"))
    words = docs.sparkSession.range(n >> 6).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = set_bits.unionByName(words).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    row = words.agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("_bits"))
    there = [F.getbit(F.get("_bits", F.shiftright(at[i], 6).cast("int")), at[i].bitwiseAND(F.lit(63)).cast("int")) == 1 for i in (0, 1)]
    return docs.crossJoin(F.broadcast(row)).withColumn("_maybe", there[0] & there[1]).drop("_bits")


def _holding(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``wanted`` (id, repeats allowed), and about one in 70 of the others."""
    return _maybe(docs, wanted).where("_maybe").drop("_maybe")


def _verified(docs: DataFrame, groups: DataFrame, words: int, least: float, name: str, step: Scratch) -> DataFrame:
    """Links (u, v), written, that connect whatever pairs of ``groups`` have shingle sets that are similar enough.

    groups: rows (key, id, mates), where mates are ids of other rows of the key. A set travels once for each row, however
    many mates are compared with it; the pairs are compared where a key's rows are and never become rows themselves.
    """
    groups = step.keep(groups, f"{name}-groups")
    sets = _holding(docs, groups.select("id")).mapInArrow(lean(_sets(words)), "id long, shingles binary")
    full = groups.join(sets, "id").select("key", "id", "mates", "shingles").repartition("key").sortWithinPartitions("key")
    links = step.keep(full.mapInArrow(lean(_agree(least)), "u long, v long"), f"{name}-links")
    step.drop(f"{name}-groups")
    return links


def _met(rows: DataFrame, near: Callable[[Column, Column], Column], block: int, name: str, step: Scratch) -> DataFrame:
    """Groups (key, id, mates) of ids of different classes under one value, from rows (value, id, class, mark).

    mates are the smaller ids that near(mark, mark) does not refuse; a member without any, in its list or others', is left out.
    A value of more than ``block`` rows is dealt into blocks, and every two of them meet, so that no group is gathered
    whole; rows of one block meet only in the group of that block alone. Blocks of a class that has more than ``block`` of
    the value's rows meet those of other rows only.
    """
    value = Window.partitionBy("value")
    rows = rows.withColumn("n", F.count(F.lit(1)).over(value)).withColumn("of", F.count(F.lit(1)).over(Window.partitionBy("value", "class")))
    rows = rows.withColumn("most", F.max(F.struct("of", "class")).over(value)).where(F.col("of") < F.col("n"))
    main = (F.col("most.of") > block) & (F.col("class") == F.col("most.class"))
    rows = step.keep(rows.select("value", "id", "class", "mark", "n", F.when(F.col("most.of") > block, F.col("most.of")).otherwise(0).alias("main_n"), main.alias("main")), f"{name}-met")
    member = F.collect_list(F.struct("id", "class", "mark", "own", "main")).alias("g")
    none = F.lit(-1).cast("long")
    small = rows.where(F.col("n") <= block).withColumn("own", F.lit(0).cast("long")).groupBy("value").agg(member)
    small = small.select("value", none.alias("_a"), none.alias("_b"), "g", F.lit(True).alias("lone"))
    parts, mains = F.ceil((F.col("n") - F.col("main_n")) / block), F.ceil(F.col("main_n") / block)
    # blocks of the main class are numbered after the others
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("main"), parts).otherwise(parts + mains) - 1)
    large = rows.where(F.col("n") > block).withColumn("own", F.when(F.col("main"), parts + F.pmod(F.xxhash64("id"), mains)).otherwise(F.pmod(F.xxhash64("id"), parts)))
    large = large.withColumn("other", F.explode(others))
    large = large.groupBy("value", F.least("own", "other").alias("_a"), F.greatest("own", "other").alias("_b")).agg(member)
    large = large.select("value", "_a", "_b", "g", (F.col("_a") == F.col("_b")).alias("lone"))

    def mates(x: Column) -> Column:
        fit = F.filter("g", lambda y: (x["id"] > y["id"]) & (x["class"] != y["class"]) & (F.col("lone") | (x["own"] != y["own"])) & F.coalesce(near(x["mark"], y["mark"]), F.lit(True)))
        return F.struct(x["id"].alias("id"), F.transform(fit, lambda y: y["id"]).alias("mates"))

    def paired(g: Column) -> Column:
        listed = F.array(F.array_distinct(F.flatten(g["mates"])))
        return F.flatten(F.transform(listed, lambda ids: F.filter(g, lambda x: (F.size(x["mates"]) > 0) | F.array_contains(ids, x["id"]))))

    # arrays of one element give names to what would be evaluated twice
    found = F.flatten(F.transform(F.array(F.transform("g", mates)), paired))
    groups = small.unionByName(large).select(F.xxhash64("value", "_a", "_b").alias("key"), F.explode(found).alias("m"))
    return groups.select("key", "m.id", "m.mates")


def _stars(pairs: DataFrame, block: int) -> DataFrame:
    """Groups (key, id, mates) of the distinct pairs (u, v, n): each u with its v, about ``block`` of n to a key."""
    parts = F.ceil(F.col("n") / block)
    stars = pairs.select(F.xxhash64("v", parts, F.pmod(F.xxhash64("u"), parts)).alias("key"), "u", "v")
    heads = stars.select("key", F.col("v").alias("id")).distinct().withColumn("mates", F.array().cast("array<long>"))
    return stars.select("key", F.col("u").alias("id"), F.array("v").alias("mates")).unionByName(heads)


def _classed(units: DataFrame, links: list[DataFrame]) -> DataFrame:
    """``units`` (id, class and more) with the classes that the links between ids join merged, each named by the smallest."""
    names = units.select("id", "class")
    links = reduce(DataFrame.unionByName, links).join(names.toDF("u", "a"), "u").join(names.toDF("v", "b"), "v")
    roots = connected(links.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")))
    return units.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("class", F.coalesce("root", "class")).drop("root")


def _counted(pairs: DataFrame) -> DataFrame:
    """The distinct pairs (u, v) with n, the number of those of v."""
    return pairs.join(pairs.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "v").select("u", "v", "n")


def similar_classes(docs: DataFrame, words: int = 5, least: float = 0.8, tables: int = 3, bits: int = 28, block: int = 128) -> DataFrame:
    """id, class_id for documents (id long, text) whose sets of word shingles are similar by at least ``least`` (Jaccard).

    ids must be distinct; the class id is the smallest id of those connected. Null and wordless texts are one class.

    1. Texts equal but for case and white space are one from here on.
    2. Of each text, ``tables`` SimHash fingerprints of ``bits`` bits are drawn, and texts of one fingerprint are verified
       against the smallest of them. This joins large groups of near copies with few pairs.
    3. Texts that share a signature (``signatures``) are verified against the smallest of them, likewise.
    4. All texts of different classes that share one are compared: by their sizes and parity bitmaps, which refuse no similar
       pair, then by their exact sets. As similar sets always share a signature, no pair is missed.
    """
    step = Scratch(docs.sparkSession)
    docs = docs.select("id", "text")
    made = step.keep(docs.mapInArrow(lean(_sketches(words, least, tables, bits)), _MADE), "sketches")
    firsts = step.keep(made.groupBy("folded").agg(F.min("id").alias("first")), "firsts")
    copies = step.keep(made.select("id", "folded").join(firsts, "folded").where("id > first").select("id"), "copies")
    # the lists of signatures stay where they are, save of those that may be copies
    parted = _maybe(made.select("id", "bases", "mark", "signatures"), copies)
    leads = parted.where(~F.col("_maybe")).unionByName(parted.where("_maybe").join(copies, "id", "left_anti")).drop("_maybe")
    shared = leads.select("id", F.explode("signatures").alias("value")).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("value")))
    shared = step.keep(shared.where("n > 1").select("value", "id"), "shared")
    leads = step.keep(leads.select("id", "bases", "mark"), "leads")

    early = leads.select("id", F.explode("bases").alias("base"))
    heads = early.groupBy("base").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("base", "head")
    pairs = early.join(heads, "base").where("id > head").select(F.col("id").alias("u"), F.col("head").alias("v")).distinct()
    found = [_verified(docs, _stars(_counted(step.keep(pairs, "pairs")), block), words, least, "early", step)]
    units = step.keep(_classed(leads.select("id", F.col("id").alias("class")), found), "units")

    def several(units: DataFrame) -> DataFrame:
        """value, id, class and the smallest row's head: what is left of the shared values that rows of several classes have."""
        value = Window.partitionBy("value")
        rows = shared.join(units.select("id", "class"), "id").withColumn("head", F.min(F.struct("id", "class")).over(value))
        return rows.withColumn("low", F.min("class").over(value)).withColumn("high", F.max("class").over(value)).where("low < high").select("value", "id", "class", "head")

    pairs = several(units).where("class <> head.class").select(F.col("id").alias("u"), F.col("head.id").alias("v")).distinct()
    found = [_verified(docs, _stars(_counted(step.keep(pairs, "starred")), block), words, least, "star", step)]
    units = step.keep(_classed(units, found), "joined")

    gap = (1 - least) / (1 + least)

    def near(x: Column, y: Column) -> Column:
        sized = F.least(x["n"], y["n"]) >= F.greatest(x["n"], y["n"]) * least - 1e-6
        differ = reduce(Column.__add__, [F.bit_count(x[f"b{i}"].bitwiseXOR(y[f"b{i}"])) for i in range(_PARITY)])
        return sized & (differ <= (x["n"] + y["n"]) * gap + 1e-6)

    mark = F.struct(F.get("mark", F.lit(0)).alias("n"), *[F.get("mark", F.lit(i + 1)).alias(f"b{i}") for i in range(_PARITY)]).alias("mark")
    rows = several(units).drop("head").join(leads.select("id", mark), "id").select("value", "id", "class", "mark")
    # a pair meets under many values: it is compared once
    mates = _met(rows, near, block, "rest", step).where(F.size("mates") > 0).groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("mates"))).alias("mates"))
    pairs = step.keep(mates.select(F.col("id").alias("u"), F.explode("mates").alias("v")), "rest")
    found = [_verified(docs, _stars(_counted(pairs), block), words, least, "rest", step)]
    classes = _classed(units, found).select(F.col("id").alias("first"), F.col("class").alias("class_id"))
    classes = step.keep(firsts.join(classes, "first").select("folded", "class_id"), "classes")
    step.drop("rest-met", "rest", "starred", "pairs", "shared", "copies", "leads", "units", "joined")
    return made.select("id", "folded").join(classes, "folded").select("id", "class_id")


def one_of_each(docs: DataFrame, words: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without those that are near duplicates of a document of smaller id (directly or over others).

    A null doc_id counts as larger than all; rows of one id are compared by their texts like any other, equal ones by
    text. Of rows equal in id and text one is kept. Null, empty and wordless texts are duplicates of each other. All
    columns stay as they are, whatever their names; an empty table stays empty.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col("doc_id").cast("long").alias("id"), "text")
    odd = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null")
    if odd.isEmpty():
        classes = similar_classes(rows.select("id", "text"), words, least)
        return rows.join(classes.where("class_id < id").select("id"), "id", "left_anti").select("row.*")
    rows = rows.groupBy(F.xxhash64("id", "text").alias("key")).agg(F.first("id").alias("doc"), F.first("text").alias("text"), F.first("row").alias("row"))
    classes = similar_classes(rows.select(F.col("key").alias("id"), "text"), words, least).withColumnRenamed("id", "key")
    # the smallest of each class by id, nulls last, then text
    order = F.struct(F.col("doc").isNull(), "doc", F.col("text").isNull(), F.sha2("text", 256), "key")
    kept = rows.join(classes, "key").groupBy("class_id").agg(F.min_by("key", order).alias("key"))
    return rows.join(kept.select("key"), "key", "left_semi").select("row.*")
