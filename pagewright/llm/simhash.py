"""SimHash near-dedup: byte-position inverted index, count filtering, verification, components.

Two 64-bit fingerprints that differ in at most 4 bits differ in at most 4 of their 8 bytes, so they share at least 4 bytes
at equal positions. A list for each single (position, byte) pair would hold a 256th of all fingerprints and its pairs would grow
with the square of the input; the lists here are keyed by the guaranteed minimum itself, four positions with their bytes,
of which there are 70 for a fingerprint. A pair meets only where it already has the minimum, its shared positional bytes
are tallied, and those that reach the minimum are verified bit by bit.

Where so many fingerprints share four positions that their list is large, the same step is taken once more within it: of the eight
half bytes of the other positions two linked fingerprints share four at equal places, so 70 lists of those take the place of the one.
No list can then have more than 2**16 fingerprints, for 48 of their 64 bits are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import as_bytes, frugal, masked, store

SHINGLE_WORDS, SEED, MOST_BITS, N_BYTES = 4, 42, 4, 8
SHARED = N_BYTES - MOST_BITS
POSITIONS = list(combinations(range(N_BYTES), SHARED))
_CHUNK = 1 << 16
#: One fingerprint in SHOWN, chosen by its hash, shows which lists are large: LARGE of those and more. It only decides where pairs meet.
SHOWN, LARGE = 64, 64


def fingerprint(raw: bytes) -> int:
    """The 64-bit SimHash of a text; 0 if it has no words."""
    words = raw.lower().split()
    n = len(words) - SHINGLE_WORDS + 1
    if not words:
        return 0
    text = b" ".join(words)
    if n < 1:
        starts, ends, n = [0], [len(text)], 1
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(lengths + 1) - 1
        starts, ends = (stop - lengths)[:n].tolist(), stop[SHINGLE_WORDS - 1 :].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        h = b"".join([digest(text[a:b], SEED) for a, b in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)])
        ones += np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(x) for x in as_bytes(batch.column(2))], np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found.view(np.int64))], ["doc_id", "text_no", "fp"])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(list, fp) for each of the 70 lists of a fingerprint; a list is its number above four bytes."""
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        by = fps.view(np.uint8).reshape(-1, N_BYTES).astype(np.int64)
        keys = np.empty((len(POSITIONS), len(fps)), np.int64)
        for k, at in enumerate(POSITIONS):
            keys[k] = k << 32
            for i, p in enumerate(at):
                keys[k] |= by[:, p] << (8 * i)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.tile(fps, len(POSITIONS)))], ["list", "fp"])


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(list, part, fp): part 0 of a list, or the 70 parts of a large one; a part is its number above four half bytes."""
    for batch in batches:
        lists, fps = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        large = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        out = [(lists[~large], np.zeros(int((~large).sum()), np.int64), fps[~large])]
        lists, fps = lists[large], fps[large]
        by = fps.view(np.uint8).reshape(-1, N_BYTES)
        rest = np.array([[p for p in range(N_BYTES) if p not in at] for at in POSITIONS])[lists >> 32]
        others = np.take_along_axis(by, rest, axis=1)
        halves = np.concatenate([others & 15, others >> 4], axis=1).astype(np.int64)
        for k, at in enumerate(POSITIONS):
            part = np.full(len(fps), (k + 1) << 16)
            for i, p in enumerate(at):
                part |= halves[:, p] << (4 * i)
            out.append((lists, part, fps))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in out])) for k in range(3)], ["list", "part", "fp"])


def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs share enough positional bytes and then differ in few enough bits."""
    x = np.ascontiguousarray(np.bitwise_xor(a, b)).view(np.uint64)
    tally = (x.view(np.uint8).reshape(-1, N_BYTES) == 0).sum(axis=1)
    return (tally >= SHARED) & (np.bitwise_count(x) <= MOST_BITS)


def _forest(fps: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of one list's links: each fingerprint reached meets only those not yet reached."""
    rest, left, right = fps, [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = linked(np.broadcast_to(at, rest.shape), rest)
            if near.any():
                new, rest = rest[near], rest[~near]
                left += [int(at)] * len(new)
                right += new.tolist()
                queue += list(new)
    return left, right


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the parts of lists; rows come sorted by list and part. The last part of a batch waits for the batches it goes on in."""

    def of(lists: np.ndarray, parts: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.r_[True, (lists[1:] != lists[:-1]) | (parts[1:] != parts[:-1])]) if len(lists) else np.empty(0, np.int64)
        size = np.diff(np.r_[start, len(lists)])
        two = start[size == 2]
        good = two[linked(fps[two], fps[two + 1])] if len(two) else two
        left, right = fps[good].tolist(), fps[good + 1].tolist()
        for at, n in zip(start[size > 2], size[size > 2], strict=True):
            more = _forest(fps[at : at + n])
            left += more[0]
            right += more[1]
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    held: list[list[np.ndarray]] = []
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(now[0]):
            continue
        ends = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
        cut = int(ends[-1]) + 1 if len(ends) else 0
        if held and (cut or (held[0][0][0], held[0][1][0]) != (now[0][0], now[1][0])):
            yield of(*(np.concatenate([*(h[k] for h in held), now[k][:cut]]) for k in range(3)))
            held = []
        elif cut:
            yield of(*(x[:cut] for x in now))
        held.append([x[cut:] for x in now])
    if held:
        yield of(*(np.concatenate([h[k] for h in held]) for k in range(3)))


def links(fps: DataFrame) -> DataFrame:
    """a, b: for every two linked fingerprints of fps(fp), no fp twice, a path of links between them, perhaps over others."""
    listed = lambda of: of.mapInArrow(frugal(_listed), "list long, fp long")
    shown = listed(fps.where(F.pmod(F.xxhash64("fp"), F.lit(SHOWN)) == 0)).groupBy("list").count().where(F.col("count") >= LARGE)
    large = store(shown.select("list", F.lit(True).alias("large")), "simhash_large")
    parts = listed(fps).join(large, "list", "left").select("list", "fp", "large").mapInArrow(frugal(_split), "list long, part long, fp long")
    return parts.repartition("list", "part").sortWithinPartitions("list", "part", "fp").mapInArrow(frugal(_links), "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_no (a hash of the text), fp, component_id, root (the component's smallest fingerprint) of every row."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_no"), F.col(text_col).alias("text"))
    rows = store(named.mapInArrow(frugal(_fingerprints), "doc_id long, text_no long, fp long"), "simhash_rows")
    kinds = store(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash_kinds")
    labels = store(components(store(links(kinds.select("fp")), "simhash_links")), "simhash_labels")
    joined = labels.join(kinds, F.col("node") == F.col("fp")).select("node", "root", "least_id")
    least = store(joined.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash_least")
    of_node = store(labels.join(least, "root").select(F.col("node").alias("fp"), "root", "component_id"), "simhash_components")
    single = F.col("root").isNull()
    of_kind = kinds.join(of_node, "fp", "left").select("fp", F.when(single, F.col("fp")).otherwise(F.col("root")).alias("root"), F.when(single, F.col("least_id")).otherwise(F.col("component_id")).alias("component_id"))
    return rows.join(store(of_kind, "simhash_of_kind"), "fp").select("doc_id", "text_no", "fp", "component_id", "root")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, fp (long), component_id.

    Texts lower-cased in A-Z are cut into words, their 4-word shingles, repeats included, hashed (XXH64, seed 42); a text of
    fewer words is one shingle, one of none (or null) has fingerprint 0, which links like any other. Fingerprints within 4 bits
    are linked; component_id is the smallest non-null doc_id of the component, null if there is none. Copies meet once, as one
    fingerprint; lists are worked off by a spanning forest, so no link between fingerprints is lost and no list emits its pairs.
    """
    return _grouped(docs, id_col, text_col).select("doc_id", "fp", "component_id")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component, that of the smallest id, null being largest.

    Of different texts under that id, the one with the smaller hash stays; of rows that repeat it, one, the same on reruns.
    """
    whole = docs.columns
    docs, names = masked(docs)
    id_col, text_col = names[id_col], names[text_col]
    found = store(_grouped(docs, id_col, text_col), "simhash_found")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    tops = found.where(first).groupBy("root").agg(F.count("*").alias("n"), F.min("text_no").alias("stay_no")).where("n > 1")
    several = store(found.where(first).join(tops, "root").select("doc_id", "text_no", (F.col("text_no") == F.col("stay_no")).alias("again")), "simhash_several")
    gone = found.where(~first).select("doc_id", "text_no", F.lit(False).alias("again")).unionByName(several).distinct()
    gone = store(gone.select(F.col("doc_id").alias("pw_id"), F.col("text_no").alias("pw_no"), F.col("again").alias("pw_again")), "simhash_gone")
    at = docs[id_col].eqNullSafe(gone["pw_id"]) & (F.xxhash64(docs[text_col]) == gone["pw_no"])
    once = docs.join(gone, at, "left_anti")
    if gone.where("pw_again").isEmpty():
        return once.toDF(*whole)
    again = docs.join(gone.where("pw_again"), at, "left_semi")
    one = again.groupBy(id_col, F.xxhash64(text_col).alias("pw_no")).agg(F.min(F.struct(F.xxhash64(*docs.columns), *docs.columns)).alias("pw_first"))
    return once.unionByName(one.select(*[F.col(f"pw_first.`{c}`").alias(c) for c in docs.columns])).toDF(*whole)
