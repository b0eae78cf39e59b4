"""Exact near-duplicate components: Jaccard join of word-shingle sets with set-relation skipping.

Sets are distinct hashed shingles of five words.  Equal sets are one record.  Tokens are
ordered by a table of shingle frequencies (its size is fixed; how good it is changes the work,
never the result) and then by hash; two sets that link share a token among the first
n - ceil(3n/4) + 1 of each.  Index lists of those tokens are walked in order of the position
a token has in its set: once positions rule a block out, the rest of the list is skipped.
Where many sets share a minimum hash, each is first checked against a few of them, and so is
each set of a long list against a few of that list, together with the pairs of short lists; the
links found make components, and long lists are then paired only between components.  All
candidates are verified on whole sets.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from compdict.checkpoints import cut
from compdict.llm.common import components, held, ship, slices

SHINGLE = 5
# Frequency table: 2 ** BITS buckets of one byte, in SLICES parts.
BITS, SLICES = 23, 64
# Parity bits of a set, in longs: two sets differ in at least as many tokens as their bits do.
PARITY = 16
# Marks of records: 2 ** MARK_BITS bits.
MARK_BITS = 24
# Minimum hashes a set, and from how many sets of one minimum leaders are worth a check.
MINIMA, CROWD = 3, 4
# Lists up to this length are paired at once; longer ones learn of components first.
SHORT_LIST = 8
# Leaders of one minimum, and of one long list.
LEADERS, LIST_LEADERS = 4, 8
BLOCK = 512
# Word hashes a worker keeps; a full cache is emptied.
WORD_CACHE = 250_000
_U = np.uint64
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], _U)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class _Words(dict):
    """Hashes of words, worked out when first asked for."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's shingles; A-Z are lower-cased."""
    known = held("words", _Words)
    if len(known) > WORD_CACHE:
        known.clear()
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, _U)
    w = np.fromiter(map(known.__getitem__, words), _U, len(words))
    n = min(SHINGLE, len(w))
    total = np.full(len(w) - n + 1, n, _U)
    for k in range(n):
        total += w[k : len(w) - n + 1 + k] * _FACTORS[k]
    return np.unique(mixed(total))


def record_of(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)


def parity(tokens: np.ndarray) -> np.ndarray:
    """Every token turns one of 64 * PARITY bits."""
    odd = np.bincount((tokens >> _U(40)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _mark(ids: np.ndarray) -> np.ndarray:
    return (mixed(ids.astype(np.int64).view(_U) * _U(3)) >> _U(64 - MARK_BITS)).astype(np.int64)


def _facts(docs: DataFrame) -> DataFrame:
    """Per document ``id, n, rec, minima, bits``; and per task its shingle counts in slices."""

    def run(batches):
        counts = np.zeros(1 << BITS, np.uint8)
        task = TaskContext.get().partitionId()
        for batch in slices(batches):
            n, rec, low, bits = [], [], [], []
            for text in batch.column(1).to_pylist():
                h = shingle_set(text)
                n.append(len(h))
                rec.append(record_of(h) if len(h) else None)
                low.append([int(mixed(h * _FACTORS[k]).min()) - (1 << 63) for k in range(MINIMA)] if len(h) else [])
                bits.append(parity(h))
                at = (h & _U((1 << BITS) - 1)).astype(np.int64)
                # a set has few tokens in one bucket; 255 stands for any larger count of a task
                np.add.at(counts, at[counts[at] < 250], 1)
            size = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(rec, pa.int64()), pa.array(low, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64())),
                 pa.nulls(size, pa.int32()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())],
                names=["id", "n", "rec", "minima", "bits", "slice", "task", "blob"],
            )
        parts = [(i, c) for i, c in enumerate(counts.reshape(SLICES, -1)) if c.any()]
        size = len(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64()), pa.nulls(size, pa.list_(pa.int64())), pa.nulls(size, pa.list_(pa.int64())),
             pa.array([p[0] for p in parts], pa.int32()), pa.array([task] * size, pa.int32()),
             pa.array([zlib.compress(p[1].tobytes(), 1) for p in parts], pa.binary())],
            names=["id", "n", "rec", "minima", "bits", "slice", "task", "blob"],
        )

    return docs.mapInArrow(run, "id bigint, n bigint, rec bigint, minima array<bigint>, bits array<bigint>, slice int, task int, blob binary")


def _levels(facts: DataFrame) -> np.ndarray:
    """Logarithm of each bucket's count over all documents; 2 ** BITS bytes reach the driver."""

    def total(rows: pd.DataFrame) -> np.ndarray:
        out = np.zeros((1 << BITS) // SLICES, np.float32)
        for kind, blob in zip(rows["task"], rows["blob"]):
            out += np.frombuffer(zlib.decompress(blob), np.uint8 if kind >= 0 else np.float32)
        return out

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": [key[0]], "task": [-1], "blob": [zlib.compress(total(rows).tobytes(), 1)]})

    def logs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": [key[0]], "levels": [np.log2(1 + total(rows)).astype(np.uint8).tobytes()]})

    blobs = facts.filter("slice IS NOT NULL").select("slice", "task", "blob")
    # two steps, so that one task never adds up the counts of all
    parts = blobs.groupBy("slice", F.floor(F.col("task") / 256)).applyInPandas(add, "slice int, task int, blob binary")
    out = np.zeros((SLICES, (1 << BITS) // SLICES), np.uint8)
    for part, levels in parts.groupBy("slice").applyInPandas(logs, "slice int, levels binary").collect():
        out[part] = np.frombuffer(levels, np.uint8)
    return out.reshape(-1)


def _marked(reps: DataFrame) -> np.ndarray:
    """Bits of the representatives' IDs: 2 ** MARK_BITS bits reach the driver, however many there are."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(_mark(b.column(0).to_numpy()) + 1, pa.int64())], names=["mark"]
            )

    marks = reps.select(F.coalesce("rep", F.lit(-1)).alias("rep")).mapInArrow(run, "mark bigint")
    out = np.zeros((1 << MARK_BITS) // 8, np.uint8)
    rows = marks.groupBy(F.call_function("bitmap_bucket_number", F.col("mark")).alias("b")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("mark"))).alias("bits")
    ).collect()
    for bucket, bits in rows:
        # marks are sent plus one: bucket k holds the marks (k - 1) * 32768 to k * 32768 - 1
        at = (bucket - 1) * 4096
        out[at : at + 4096] |= np.frombuffer(bytes(bits), np.uint8)
    return out


def _texts(batch: pa.RecordBatch, bits: np.ndarray) -> list[str]:
    """Texts of the rows whose ID is marked; the others are not looked at."""
    marks = _mark(batch.column(0).fill_null(-1).to_numpy())
    hit = (bits[marks >> 3] >> (marks & 7).astype(np.uint8)) & 1
    return batch.column(1).filter(pa.array(hit.astype(bool))).to_pylist()


def _sets(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """``(rec, tokens)`` of the marked records, and of a few others whose mark is the same."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in slices(batches):
            recs, sets = [], []
            for text in _texts(batch, sent.value):
                h = shingle_set(text)
                if len(h):
                    recs.append(record_of(h))
                    sets.append(h.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(recs, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["rec", "tokens"])

    return docs.mapInArrow(run, "rec bigint, tokens array<bigint>")


def _verified(docs: DataFrame, pairs: DataFrame, recs: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of records that link, by their whole sets.

    Linked sets differ in at most a seventh of their sizes' sum; pairs whose parity bits
    already differ in more leave before sets are fetched.
    """
    own = recs.select("rec", "n", "bits")
    differ = F.aggregate(F.zip_with("ba", "bb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, c: t + c)
    pairs = cut(
        pairs.join(own.select(F.col("rec").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba")), "a")
        .join(own.select(F.col("rec").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb")), "b")
        .filter(7 * differ <= F.col("na") + F.col("nb")).select("a", "b")
    )
    used = pairs.select(F.explode(F.array("a", "b")).alias("rec")).distinct()
    needed = recs.join(used, "rec", "left_semi").select("rec", "rep")
    sets = _sets(docs, _marked(needed)).dropDuplicates(["rec"])
    return cut(
        pairs.join(sets.select(F.col("rec").alias("a"), F.col("tokens").alias("x")), "a")
        .join(sets.select(F.col("rec").alias("b"), F.col("tokens").alias("y")), "b")
        .withColumn("common", F.size(F.array_intersect("x", "y")))
        .filter(100 * F.col("common") >= 75 * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b")
    )


def _prefixes(docs: DataFrame, levels: np.ndarray, reps: np.ndarray) -> DataFrame:
    """``(token, rec, n, pos)`` of the prefix tokens of every record."""
    sent = docs.sparkSession.sparkContext.broadcast((levels, reps))

    def run(batches):
        level, bits = sent.value
        for batch in slices(batches):
            out = []
            for text in _texts(batch, bits):
                h = shingle_set(text)
                n = len(h)
                if n:
                    rec = record_of(h)
                    p = n - -(-3 * n // 4) + 1
                    order = np.argsort(level[(h & _U((1 << BITS) - 1)).astype(np.int64)], kind="stable")[:p]
                    out.append((h[order].view(np.int64), np.full(p, rec, np.int64), np.full(p, n, np.int32), np.arange(p, dtype=np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["token", "rec", "n", "pos"])

    return docs.mapInArrow(run, "token bigint, rec bigint, n int, pos int")


def _pair_list(rec, n, pos, comp, bits) -> list[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of one list, between components only, block by block in order of position.

    A pair counts at its first shared token, so at most 1 + min(n - pos - 1) tokens are shared.
    """
    rest = n - pos
    order = np.argsort(-rest, kind="stable")
    rec, n, rest, comp = rec[order], n[order].astype(np.int64), rest[order], comp[order]
    bits = None if bits is None else bits[order]
    out = []
    for i in range(0, len(rec), BLOCK):
        a = slice(i, i + BLOCK)
        for j in range(i, len(rec), BLOCK):
            b = slice(j, j + BLOCK)
            # positions only get worse: no pair with this block or a later one can reach its size
            if 7 * rest[j] < 3 * (n[a].min() + n[j:].min()):
                break
            may = np.minimum.outer(rest[a], rest[b]) * 7 >= 3 * np.add.outer(n[a], n[b])
            may &= np.minimum.outer(n[a], n[b]) * 4 >= 3 * np.maximum.outer(n[a], n[b])
            may &= np.not_equal.outer(comp[a], comp[b])
            x, y = np.nonzero(may)
            if bits is not None:
                differ = np.bitwise_count((bits[a][x] ^ bits[b][y]).view(_U)).sum(1, dtype=np.int64)
                close = 7 * differ <= n[a][x] + n[b][y]
                x, y = x[close], y[close]
            x, y = rec[a][x], rec[b][y]
            out.append((np.minimum(x, y), np.maximum(x, y)))
    return out


def _led(rec, n, pos) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs of a list's leaders with its other members: a fixed number a member."""
    rest, n = n - pos, n.astype(np.int64)
    # members whose position allows a link to one of their own size come first
    lead = np.lexsort((mixed(rec.view(_U)), 7 * rest < 6 * n))[:LIST_LEADERS]
    may = np.minimum.outer(rest[lead], rest) * 7 >= 3 * np.add.outer(n[lead], n)
    may &= np.minimum.outer(n[lead], n) * 4 >= 3 * np.maximum.outer(n[lead], n)
    may &= np.not_equal.outer(rec[lead], rec)
    x, y = np.nonzero(may)
    x, y = rec[lead][x], rec[y]
    return np.minimum(x, y), np.maximum(x, y)


def _lists(rows: DataFrame, short: int | None) -> DataFrame:
    """Pairs ``(a, b)`` of the lists; with ``short``, longer lists give pairs with their leaders
    only, and their rows come out as they are; without it, rows bring their parity bits.

    ``rows`` are dealt by token and sorted by it; a list may span batches.
    """

    def run(batches):
        held = None
        for batch in batches:
            part = {c: batch.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(("token", "rec", "n", "pos", "comp"))}
            if short is None:
                part["bits"] = batch.column(5).flatten().to_numpy().reshape(-1, PARITY)
            if held is not None:
                part = {c: np.concatenate([held[c], part[c]]) for c in part}
            if not len(part["token"]):
                continue
            end = np.searchsorted(part["token"], part["token"][-1])
            held = {c: v[end:] for c, v in part.items()}
            if end:
                yield from made({c: v[:end] for c, v in part.items()})
        if held is not None:
            yield from made(held)

    def made(part):
        starts = np.flatnonzero(np.diff(part["token"], prepend=part["token"][0] - 1))
        sizes = np.diff(starts, append=len(part["token"]))
        pairs, long = [], []
        for s, k in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            rec, first = np.unique(part["rec"][s : s + k], return_index=True)
            if len(rec) < 2:
                continue
            if short is not None and len(rec) > short:
                long.append(s + first)
                pairs.append(_led(rec, part["n"][s + first], part["pos"][s + first]))
            else:
                at = s + first
                pairs += _pair_list(rec, part["n"][at], part["pos"][at], part["comp"][at], part["bits"][at] if short is None else None)
        if pairs:
            both = np.unique(np.stack([np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])], 1), axis=0)
            k = len(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32())],
                names=["a", "b", "token", "rec", "n", "pos"],
            )
        if long:
            at = np.concatenate(long)
            k = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), *(pa.array(part[c][at]) for c in ("token", "rec", "n", "pos"))],
                names=["a", "b", "token", "rec", "n", "pos"],
            )

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("token", "rec", "n", "pos", "comp", *(["bits"] if short is None else [])).repartition(parts, "token").sortWithinPartitions("token")
    return dealt.mapInArrow(run, "a bigint, b bigint, token bigint, rec bigint, n int, pos int")


def _between(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """``(a, b, ca, cb)``: the pairs whose components ``ca``, ``cb`` differ."""
    of = known.select("rec", "comp")
    return (
        pairs.join(of.select(F.col("rec").alias("a"), F.col("comp").alias("ca")), "a")
        .join(of.select(F.col("rec").alias("b"), F.col("comp").alias("cb")), "b").filter("ca <> cb")
    )


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)``, one row per input row.

    Two documents link when 100 * common >= 75 * union of their shingle sets; ``component_id``
    is the smallest ID reachable by links, the own one included.  Null, empty and blank texts
    have no shingles and are linked with nothing.  Repeated rows are copies of each other.  A
    null ID keeps its row; it is never a component's ID unless no other ID is there.  Other
    columns are not carried.  Shingles are compared by 64-bit hashes.
    """
    base = ship(docs).select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    facts = cut(_facts(base))
    levels = _levels(facts)
    slim = facts.filter("slice IS NULL")
    recs = cut(slim.filter("n > 0").groupBy("rec").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("minima").alias("minima"), F.first("bits").alias("bits")))

    # many sets of one minimum hash: each is checked against a few of them
    lows = recs.select("rec", "n", F.posexplode("minima").alias("k", "low"))
    crowds = lows.groupBy("k", "low").agg(
        F.array_distinct(F.array(*[F.min_by(F.struct("rec", "n"), F.xxhash64("rec", F.lit(j))) for j in range(LEADERS)])).alias("leads"),
        F.count(F.lit(1)).alias("size"),
    ).filter(F.col("size") > CROWD)
    leads = (
        lows.join(crowds, ["k", "low"]).select("rec", "n", F.explode("leads").alias("lead"))
        .filter("rec <> lead.rec AND 4 * least(n, lead.n) >= 3 * greatest(n, lead.n)")
        .select(F.least("rec", "lead.rec").alias("a"), F.greatest("rec", "lead.rec").alias("b")).distinct()
    )
    rows = _prefixes(base, levels, _marked(recs)).withColumn("comp", F.col("rec"))
    found = cut(_lists(rows, SHORT_LIST))
    first = cut(found.filter("a IS NOT NULL").select("a", "b").unionByName(leads).distinct())
    derived = components(_verified(base, first, recs))

    # long lists are paired between the components that are known by now
    long = (
        found.filter("token IS NOT NULL").select("token", "rec", "n", "pos")
        .join(derived.select(F.col("node").alias("rec"), F.col("label")), "rec", "left")
        .join(recs.select("rec", "bits"), "rec")
        .select("token", "rec", "n", "pos", F.coalesce("label", "rec").alias("comp"), "bits")
    )
    # links within a component are known; of all links between two components one is enough
    known = cut(recs.select("rec", "rep").join(derived, recs["rec"] == F.col("node"), "left").select("rec", "rep", F.coalesce("label", "rec").alias("comp")))
    candidates = cut(_lists(long, None).select("a", "b").distinct())
    links = _between(_verified(base, candidates, recs), known).select(
        F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")
    ).distinct()

    merged = components(links).select(F.col("node").alias("comp"), F.col("label").alias("merged"))
    labelled = known.join(merged, "comp", "left").select("rec", "rep", F.coalesce("merged", "comp").alias("label"))
    least = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    answer = labelled.join(least, "label").select(F.col("rec").alias("_rec"), "component_id")
    return slim.join(answer, F.col("rec") == F.col("_rec"), "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
