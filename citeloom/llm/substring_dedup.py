"""Substring dedup by De Bruijn compaction of token k-mers.

Each window of ``k`` words is an edge of the De Bruijn graph, from the node of its first k-1 words to that of its last
k-1. An edge is repeated when documents of different ids hold it. The steps, each a table in the shared folder:

1. *Copies.* Whole-text copies of a smaller id are known from a digest and stand back from what follows.
2. *Minimisers.* Consecutive windows share the smallest hash of their inner ``mini``-word runs, so about an eighth of
   the windows' number is shuffled. Equal windows have equal minimisers; only windows with a minimiser that two
   documents have go on.
3. *Edges.* Each document sends its distinct candidate edges with both nodes. A pre-aggregated group by edge leaves the
   repeated ones, each with its source coordinates: the first document that holds it, and the position there.
4. *Compaction.* A node that one repeated edge enters and one leaves is no branch: a join on such nodes links their two
   edges, and linked edges whose source coordinates succeed one another make a nonbranching path.
5. *Spans.* A join on the edge tells the later documents which path they walk; each unbroken walk is one span.
6. *Verification.* A join on the source document compares a digest of the span's words with those at the source
   coordinates. Requests to one much-copied source are dealt into chunks. Where a digest differs (a hash collision),
   the span's windows are grouped by their words themselves.
7. *Cover.* Verified spans, and windows that repeat within the document, mark the words to remove.

Nothing is collected per edge, node or minimiser: hot ones are counted by partial aggregates, which are written, so that
the joins back to them read two exchanges, which AQE can split. Lists are gathered per document, and bounded by its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.textops import Scratch, U, bytes_of, mix, run_hashes, sliding_min, small_batches, windows_in, word_hashes, word_spans

#: A null id counts as this, larger than all.
LAST = 2**63 - 1
KEY = ["k", "tag"]
_OTHER = U(0xC2B2AE3D27D4EB4F)  # an odd multiplier, for a second hash of a window


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _words(batch: pa.RecordBatch) -> tuple:
    data, off = bytes_of(_column(batch, "text"))
    start, end, first = word_spans(data, off)
    return data, start, end, first, word_hashes(data, start, end)


def _minimisers(h: np.ndarray, at: np.ndarray, k: int, mini: int) -> np.ndarray:
    return sliding_min(mix(run_hashes(h, mini)), k - mini + 1)[at]


def _send_minimisers(k: int, mini: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            _, _, _, first, h = _words(b)
            at, doc = windows_in(first, k)
            m = _minimisers(h, at, k, mini)
            order = np.lexsort((m, doc))
            m, doc = m[order], doc[order]
            new = np.ones(len(m), bool)
            new[1:] = (m[1:] != m[:-1]) | (doc[1:] != doc[:-1])
            who = pa.array(doc[new])
            yield pa.RecordBatch.from_arrays([pa.array(m[new].view(np.int64)), _column(b, "k").take(who), _column(b, "tag").take(who)], ["m", *KEY])

    return run


def _send_edges(k: int, mini: int, mask: U) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            _, _, _, first, h = _words(b)
            at, doc = windows_in(first, k)
            # a minimiser that any document has repeated is repeated for all of them
            known = _column(b, "marks").flatten().to_numpy(zero_copy_only=False).view(U)
            keep = np.flatnonzero(np.isin(_minimisers(h, at, k, mini), known))
            edge, node, twin = run_hashes(h, k), mix(run_hashes(h, k - 1)), run_hashes(h, k, _OTHER)
            w, x = mix(edge[at[keep]]) & mask, twin[at[keep]]
            order = np.lexsort((at[keep], x, w, doc[keep]))
            w, x, keep = w[order], x[order], keep[order]
            new = np.ones(len(keep), bool)
            new[1:] = (w[1:] != w[:-1]) | (x[1:] != x[:-1]) | (doc[keep][1:] != doc[keep][:-1])
            back = np.argsort(keep[new])
            w, keep = w[new][back], keep[new][back]
            i, who = at[keep], pa.array(doc[keep])
            hashes = [pa.array(v.view(np.int64)) for v in (w, node[i], node[i + 1] if len(i) else node[:0])]
            yield pa.RecordBatch.from_arrays([*hashes, _column(b, "k").take(who), _column(b, "tag").take(who), pa.array(i - first[:-1][doc[keep]])], ["h", "head", "tail", *KEY, "p"])

    return run


def _digest(data: np.ndarray, start: np.ndarray, end: np.ndarray, a: int, b: int) -> bytes:
    """Digest of words a to b-1 joined by a space."""
    return hashlib.blake2b(b" ".join(data[start[a] : end[b - 1]].tobytes().split()), digest_size=16).digest()


_SPAN = ["k", "tag", "start", "n", "k0", "tag0", "p0"]


def _digests(k: int) -> Callable:
    """Of each span of a document, with the span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            data, start, end, first, _ = _words(b)
            lists = _column(b, "spans")
            size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            who, spans = np.repeat(np.arange(b.num_rows), size), lists.flatten()
            at = first[who] + spans.field("start").to_numpy(zero_copy_only=False)
            to = at + spans.field("n").to_numpy(zero_copy_only=False) + k - 1
            marks = [_digest(data, start, end, x, y) for x, y in zip(at.tolist(), to.tolist())]
            who = pa.array(who)
            cols = [_column(b, "k").take(who), _column(b, "tag").take(who), *[spans.field(c) for c in _SPAN[2:]], pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, [*_SPAN, "digest"])

    return run


def _verify(k: int) -> Callable:
    """The asked spans, each with whether the document's words at the place are those of the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            data, start, end, first, _ = _words(b)
            lists = _column(b, "asked")
            size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            who, asked = np.repeat(np.arange(b.num_rows), size), lists.flatten()
            at = first[who] + asked.field("p0").to_numpy(zero_copy_only=False)
            to = at + asked.field("n").to_numpy(zero_copy_only=False) + k - 1
            known: dict[tuple[int, int], bytes] = {}
            equal = []
            for x, y, last, want in zip(at.tolist(), to.tolist(), first[who + 1].tolist(), asked.field("digest").to_pylist()):
                if y <= last and (x, y) not in known:
                    known[x, y] = _digest(data, start, end, x, y)
                equal.append(y <= last and known[x, y] == want)
            yield pa.RecordBatch.from_arrays([*[asked.field(c) for c in _SPAN[:4]], pa.array(equal, pa.bool_())], [*_SPAN[:4], "equal"])

    return run


def _spell(k: int) -> Callable:
    """The words of the asked windows, joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            data, start, end, first, _ = _words(b)
            lists = _column(b, "places")
            who = np.repeat(np.arange(b.num_rows), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
            p = lists.flatten().to_numpy(zero_copy_only=False)
            spelt = [b" ".join(data[start[x] : end[x + k - 1]].tobytes().split()).decode() for x in (first[who] + p).tolist()]
            who = pa.array(who)
            yield pa.RecordBatch.from_arrays([pa.array(spelt, pa.string()), _column(b, "k").take(who), _column(b, "tag").take(who), pa.array(p)], ["words", *KEY, "p"])

    return run


def _own_repeats(data: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray, at: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """First words of the windows whose words also start earlier in their document."""
    w = run_hashes(h, k)[at]
    order = np.lexsort((at, w, doc))
    same = np.r_[False, (w[order][1:] == w[order][:-1]) & (doc[order][1:] == doc[order][:-1])]
    if not same.any():
        return at[:0]
    heads = np.flatnonzero(~same)
    group = np.cumsum(~same) - 1
    later = np.flatnonzero(same)
    one, two = at[order[heads[group[later]]]], at[order[later]]
    # equal hashes are candidates; the words themselves, each spelling once numbered, decide
    used = np.zeros(len(h) + 1, np.int64)
    for x in (one, two):
        np.add.at(used, x, 1)
        np.add.at(used, x + k, -1)
    used = np.flatnonzero(np.cumsum(used[:-1]) > 0)
    number: dict[bytes, int] = {}
    ids, raw = np.zeros(len(h), np.int64), data.tobytes()
    ids[used] = [number.setdefault(raw[a:b], len(number)) for a, b in zip(start[used].tolist(), end[used].tolist())]
    equal = np.ones(len(one), bool)
    for j in range(k):
        equal &= ids[one + j] == ids[two + j]
    found = two[equal].tolist()
    for g in np.unique(group[later[~equal]]):  # hash collisions: each of the group against all before it
        seen = set()
        for i in at[order[group == g]].tolist():
            if (words := ids[i : i + k].tobytes()) in seen:
                found.append(i)
            seen.add(words)
    return np.unique(np.array(found, np.int64))


def _cover(k: int) -> Callable:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            data, start, end, first, h = _words(b)
            over = np.zeros(len(start) + 1, np.int64)
            own = _own_repeats(data, start, end, h, *windows_in(first, k), k)
            np.add.at(over, own, 1)
            np.add.at(over, own + k, -1)
            spans, copies = _column(b, "spans"), _column(b, "copy_of").is_valid().to_pylist()
            for i in range(b.num_rows):
                if copies[i] and first[i + 1] - first[i] >= k:
                    over[first[i]] += 1
                    over[first[i + 1]] -= 1
                elif spans[i].is_valid:
                    for s in spans[i].as_py():
                        over[first[i] + s["start"]] += 1
                        over[first[i] + s["start"] + s["n"] + k - 1] -= 1
            gone = np.cumsum(over[:-1]) > 0
            total = np.r_[0, np.cumsum(gone)]
            texts, removed = [], []
            for i in range(b.num_rows):
                lo, hi = first[i], first[i + 1]
                g = gone[lo:hi]
                words = data[start[lo] : end[hi - 1]].tobytes().split() if lo < hi else []
                edge = np.flatnonzero(np.diff(np.r_[False, g, False].astype(np.int8)))
                removed.append([{"start": int(a), "n": int(z - a)} for a, z in edge.reshape(-1, 2)])
                texts.append(b" ".join([x for x, y in zip(words, g.tolist()) if not y] if len(edge) else words).decode())
            cols = [pa.array(np.diff(first).astype(np.int64)), pa.array((total[first[1:]] - total[first[:-1]]).astype(np.int64)), pa.array(texts, pa.string()), pa.array(removed, kind)]
            yield pa.RecordBatch.from_arrays([_column(b, "doc_id"), *cols], ["doc_id", "n_words", "n_removed", "kept_text", "removed"])

    return run


def _deal(rows: DataFrame, asked: DataFrame, by: list[str], size: int, spread: list[str], salts: int = 64) -> DataFrame:
    """Add ``chunk``: the rows of one key spread over as many chunks as keep each near ``size`` rows.

    ``asked`` holds as many rows of each key as ``rows``. The keys of more than ``size`` rows are repeated for each salt, so
    that no task has to hold all rows of one.
    """
    many = asked.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > size)
    many = many.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    chunk: Column = F.pmod(F.xxhash64(*spread), F.ceil(F.col("_n") / size))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(F.lit("salt"), *spread), F.lit(salts)))
    return rows.join(many, [*by, "_salt"], "left").withColumn("chunk", F.coalesce(chunk, F.lit(0))).drop("_n", "_salt")


def _paths(source: DataFrame) -> DataFrame:
    """h, k0, tag0, p0, path: each repeated edge with its source coordinates and its path's first position there.

    A path goes on from an edge to the next at the source if the node between them has one edge in and one out.
    """
    enters = source.groupBy(F.col("tail").alias("node")).agg(F.count(F.lit(1)).alias("_in"), F.min(F.struct("k0", "tag0", "p0")).alias("a")).where("_in = 1")
    leaves = source.groupBy(F.col("head").alias("node")).agg(F.count(F.lit(1)).alias("_out"), F.min(F.struct("k0", "tag0", "p0")).alias("b")).where("_out = 1")
    linked = enters.join(leaves, "node").where("a.k0 = b.k0 and a.tag0 = b.tag0 and a.p0 + 1 = b.p0").select("b.k0", "b.tag0", "b.p0")
    # one pass over each source document: a link's row stands just before that of the edge it leads to
    both = source.select("h", "k0", "tag0", "p0", F.lit(1).alias("edge")).unionByName(linked.withColumn("edge", F.lit(0)), allowMissingColumns=True)
    along = Window.partitionBy("k0", "tag0").orderBy("p0", "edge")
    goes_on = (F.lag("edge").over(along) == 0) & (F.lag("p0").over(along) == F.col("p0"))
    begun = F.when((F.col("edge") == 1) & ~F.coalesce(goes_on, F.lit(False)), F.col("p0"))
    return both.withColumn("_b", begun).withColumn("path", F.last("_b", ignorenulls=True).over(along)).where("edge = 1").select("h", "k0", "tag0", "p0", "path")


def _walks(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """k, tag, start, n, k0, tag0, p0: the unbroken walks of later documents along a path, from its place p0 at the source."""
    met = edges.select("h", *KEY, "p").join(paths, "h").where("k > k0")
    order = Window.partitionBy(*KEY).orderBy("p", "k0", "tag0", "p0")
    same = [F.lag(c).over(order) == F.col(c) for c in ("k0", "tag0", "path")] + [F.lag(c).over(order) + 1 == F.col(c) for c in ("p", "p0")]
    broken = ~F.coalesce(same[0] & same[1] & same[2] & same[3] & same[4], F.lit(False))
    met = met.withColumn("_new", broken.cast("int")).withColumn("walk", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.min(F.struct("p", "k0", "tag0", "p0"))
    walks = met.groupBy(*KEY, "walk").agg(first.alias("s"), F.count(F.lit(1)).cast("int").alias("n"))
    return walks.select(*KEY, F.col("s.p").cast("int").alias("start"), "n", "s.k0", "s.tag0", F.col("s.p0").alias("p0"))


def _spelt_out(docs: DataFrame, edges: DataFrame, failed: DataFrame, k: int) -> DataFrame:
    """k, tag, start, n: of all documents, the windows that share a hash with a failed span and whose words are a smaller id's."""
    place = failed.select(*KEY, F.explode(F.sequence(F.col("start").cast("long"), F.col("start") + F.col("n") - F.lit(1).cast("long"))).alias("p"))
    doubtful = edges.join(place, [*KEY, "p"]).select("h").distinct()
    places = edges.join(doubtful, "h").groupBy(*KEY).agg(F.collect_set("p").alias("places"))
    spelt = docs.select(*KEY, "text").join(places, KEY).mapInArrow(_spell(k), "words string, k long, tag string, p long")
    least = spelt.groupBy("words").agg(F.min("k").alias("k0"))
    return spelt.join(least, "words").where("k > k0").select(*KEY, F.col("p").cast("int").alias("start"), F.lit(1).alias("n"))


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(k, tag, doc_id, text) of all rows, and of one row for each k and tag. tag tells rows of one id apart by their texts."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("k"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    twice = docs.groupBy("k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("k", F.lit(True).alias("_twice"))
    if twice.isEmpty():
        docs = docs.select("k", F.lit("").alias("tag"), "doc_id", "text")
        return docs, docs
    tag = F.when(F.col("_twice"), F.substring(F.sha2("text", 256), 1, 32))
    docs = docs.join(twice, "k", "left").select("k", F.coalesce(tag, F.lit("")).alias("tag"), "doc_id", "text")
    return docs, docs.groupBy(*KEY).agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))


def dedup_substrings(docs: DataFrame, k: int = 20, mini: int = 6, chunk: int = 2000, bits: int = 64) -> DataFrame:
    """Remove from ``docs`` (doc_id long, text string) every word inside a ``k``-word window that also starts earlier.

    Earlier: in a document of smaller id, or before in the same document. Returns one row per input row: doc_id,
    n_words, n_removed, kept_text (kept words joined by one space), removed (array of word start and count).
    Null and empty texts have no words. Rows of equal doc_id are judged each against smaller ids and itself, not
    against each other; a null doc_id counts as larger than all. Extra columns are ignored. Edges are told apart by
    ``bits`` of a hash, and removed by their words alone: a collision costs time, no word.
    """
    step = Scratch(docs.sparkSession)
    docs, lone = _keyed(docs)
    digests = lone.where("text is not null").select(*KEY, F.unhex(F.sha2("text", 256)).alias("digest"))
    same = step.keep(digests.groupBy("digest").agg(F.min("k").alias("copy_of"), F.max("k").alias("_most")).where("copy_of < _most").drop("_most"), "texts")
    copies = step.keep(digests.join(same, "digest").where("copy_of < k").select(*KEY, "copy_of"), "copies")

    rest = lone.join(copies, KEY, "left_anti")
    seen = step.keep(rest.mapInArrow(_send_minimisers(k, mini), "m long, k long, tag string"), "minimisers")
    repeated = step.keep(seen.groupBy("m").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("m"), "repeated")
    marks = step.keep(seen.join(repeated, "m").groupBy(*KEY).agg(F.collect_set("m").alias("marks")), "marks")
    step.drop("texts", "minimisers", "repeated")

    edges = step.keep(lone.join(marks, KEY).mapInArrow(_send_edges(k, mini, U((1 << bits) - 1)), "h long, head long, tail long, k long, tag string, p long"), "edges")
    step.drop("marks")
    first = F.min(F.struct("k", "tag", "p", "head", "tail")).alias("s")
    source = edges.groupBy("h").agg(first, F.max("k").alias("_z")).where("s.k < _z")
    source = step.keep(source.select("h", "s.head", "s.tail", F.col("s.k").alias("k0"), F.col("s.tag").alias("tag0"), F.col("s.p").alias("p0")), "source")
    paths = step.keep(_paths(source), "paths")
    step.drop("source")
    walks = step.keep(_walks(edges, paths), "walks")
    step.drop("paths")

    spans = walks.groupBy(*KEY).agg(F.collect_list(F.struct(*_SPAN[2:])).alias("spans"))
    drawn = lone.join(spans, KEY).mapInArrow(_digests(k), "k long, tag string, start int, n int, k0 long, tag0 string, p0 long, digest binary")
    asked = _deal(drawn, walks, ["k0", "tag0"], chunk, ["k", "tag", "start"]).groupBy("k0", "tag0", "chunk").agg(F.collect_list(F.struct(*_SPAN[:4], "p0", "digest")).alias("asked"))
    asked = asked.select(F.col("k0").alias("k"), F.col("tag0").alias("tag"), "asked")
    checked = step.keep(lone.join(asked, KEY).mapInArrow(_verify(k), "k long, tag string, start int, n int, equal boolean"), "checked")
    sound, failed = checked.where("equal").drop("equal"), checked.where("not equal")
    if not failed.isEmpty():
        sound = step.keep(sound.unionByName(_spelt_out(lone, edges, failed, k)), "sound")
    step.drop("edges", "walks")

    gone = sound.groupBy(*KEY).agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    full = docs.join(copies, KEY, "left").join(gone, KEY, "left")
    return full.mapInArrow(_cover(k), "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start:int,n:int>>")


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
