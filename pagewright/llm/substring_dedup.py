"""Substring dedup by sliding sentence spans: runs of consecutive sentences are hashed, met globally, and sentences under a
non-first repeated run are removed.

A sentence ends at a full stop, question or exclamation mark before white space, or at a line's end. A sentence of over LONG_WORDS
words is cut further after words chosen by their own hash, so that the same passage is cut alike wherever it stands. From every
sentence a run goes on until it has RUN_SENTENCES sentences and RUN_WORDS words, and to every sentence one comes from as near, so
a repeated passage is under runs to its last sentence. A piece or two of a cut sentence are a run if they have RUN_WORDS words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import as_bytes, store

RUN_SENTENCES, RUN_WORDS, LONG_WORDS, CUT_ONE_IN, SEED = 3, 20, 16, 5, 7
#: A run has fewer than 2 to so many sentences: it ends where it has RUN_WORDS words.
_PLACE_BITS = 16
_SENTENCE = re.compile(rb"[^\n.!?]+(?:[.!?]+(?!\s|\Z)[^\n.!?]*)*[.!?]*|[.!?]+")
_SPACED = re.compile(rb"[^\x20\x09-\x0D]+")


class _Cuts(dict):
    """Whether a long sentence is cut after a word: one word in CUT_ONE_IN, by its hash. Words met are remembered, so many at most."""

    def __missing__(self, word: bytes) -> bool:
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, SEED) % CUT_ONE_IN == 0
        return found


_CUTS = _Cuts()


def sentences(raw: bytes) -> list[tuple[int, int, int, int, bool]]:
    """(begin, end, words, hash, cut from a long sentence) in bytes, of all sentences that have a word; a sentence reaches to its last word's end."""
    out, digest, low, cuts = [], xxhash.xxh64_intdigest, raw.lower(), _CUTS
    for m in _SENTENCE.finditer(low):
        begin, end = m.span()
        words = low[begin:end].split()
        if not words:
            continue
        begin, end = low.index(words[0], begin), low.rindex(words[-1], begin, end) + len(words[-1])
        if len(words) <= LONG_WORDS:
            out.append((begin, end, len(words), digest(b" ".join(words), SEED), False))
            continue
        if sum(map(len, words)) + len(words) - 1 == end - begin:  # a space between words and no more
            starts = [begin, *accumulate((len(w) + 1 for w in words), initial=begin)][1:]
        else:
            starts = [begin + x.start() for x in _SPACED.finditer(low[begin:end])]
        first, last = 0, len(words) - 1
        for k in [k for k, w in enumerate(words) if cuts[w] or k == last]:
            out.append((starts[first], starts[k] + len(words[k]), k + 1 - first, digest(b" ".join(words[first : k + 1]), SEED), True))
            first = k + 1
    return out


def runs(found: list[tuple[int, int, int, int, bool]]) -> list[tuple[int, int, bytes]]:
    """(first sentence, number of sentences, hash of 16 bytes) of every run: the shortest from each sentence and to each, by place."""
    digest = xxhash.xxh3_128_digest
    hashes = [x[3].to_bytes(8, "big") for x in found]
    sizes, cut = [x[2] for x in found], [x[4] for x in found]
    spans, begin, words, last = [], 0, 0, -1
    for end in range(len(found)):
        words += sizes[end]
        nearest = -1
        # What is a run stays one with a sentence more, so both ends only go forward.
        while words >= RUN_WORDS:
            n = end + 1 - begin
            if n < RUN_SENTENCES and n > 1 and not (cut[begin] and cut[end]) and sizes[begin] < RUN_WORDS and sizes[end] < RUN_WORDS:
                break
            spans.append((begin, n))  # the shortest from `begin`: it was no run up to the sentence before
            nearest = last = begin
            words -= sizes[begin]
            begin += 1
        if nearest < 0 and last >= 0:
            spans.append((last, end + 1 - last))  # the shortest to `end`
    spans.sort()
    return [(k, n, digest(b"".join(hashes[k : k + n]), SEED)) for k, n in spans]


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_no, run and proof (96 bits of its hash), place (first sentence above length) of every run of a text; again: the same text has the run further up."""
    for batch in batches:
        rows, hashes, firsts, lengths, again = [], [], [], [], []
        for row, raw in enumerate(as_bytes(batch.column(2))):
            found = runs(sentences(raw))
            if not found:
                continue
            first, length, run = zip(*found, strict=True)
            seen: set[int] = set()
            again += [h in seen or bool(seen.add(h)) for h in run]
            rows += [row] * len(run)
            hashes += run
            firsts += first
            lengths += length
        at = pa.array(rows, pa.int64())
        half = np.frombuffer(b"".join(hashes), [("run", "<i8"), ("proof", "<i4"), ("more", "<i4")])
        place = (np.array(firsts, np.int64) << _PLACE_BITS) + np.array(lengths, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(half["run"].copy()), pa.array(half["proof"].copy()), pa.array(place), pa.array(again, pa.bool_())],
            ["doc_id", "text_no", "run", "proof", "place", "again"],
        )


def without(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int, list[dict[str, int]]]:
    """(text without the sentences of the spans (first, length), sentences removed, their words, stretches removed in code points).

    The white space after a removed stretch goes with it.
    """
    found = sentences(raw)
    gone = bytearray(len(found))
    for first, length in spans:
        gone[first : first + length] = b"\1" * length
    parts, cut, at, k = [], [], 0, 0
    while k < len(found):
        begin = k
        while k < len(found) and gone[k]:
            k += 1
        if k > begin:
            parts.append(raw[at : found[begin][0]])
            cut.append({"begin": len(raw[: found[begin][0]].decode()), "end": len(raw[: found[k - 1][1]].decode())})
            at = found[k][0] if k < len(found) else len(raw)
        else:
            k += 1
    parts.append(raw[at:])
    return b"".join(parts), sum(gone), sum(x[2] for x, g in zip(found, gone, strict=True) if g), cut


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known = batch.column(2).to_pylist()
        done = [without(raw, [(x >> _PLACE_BITS, x & (1 << _PLACE_BITS) - 1) for x in gone]) if gone else (raw, 0, 0, []) for raw, gone in zip(as_bytes(batch.column(1)), known, strict=True)]
        texts, counts, words, spans = zip(*done, strict=True) if done else ([], [], [], [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(words, pa.int64()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
            ["doc_id", "text", "n_removed", "removed_words", "spans"],
        )


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, text (what stays), n_removed (sentences), removed_words, spans array<struct<begin, end>>.

    A run's first occurrence is that of the smallest doc_id, null being last, in it the first place. It stays; every other occurrence,
    also one further on in the same text, is removed with all its sentences. A row's doc_id and text are its name: rows that repeat both
    are one document and keep the same; of different texts under one id, the one with the smaller hash comes first. A null text is
    empty. Case in A-Z and kinds of white space don't count. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_no"), text.alias("text"))
    # Texts are parsed once; what is found is met twice, from a written table.
    spans = store(named.mapInArrow(_spans, "doc_id long, text_no long, run long, proof int, place long, again boolean"), "substring_spans")
    # Plain longs, so copies of a run meet in hash maps before the shuffle. A null id is after all others. A run is 96 bits of its hash:
    # at 10^12 runs 64 of them would meet by chance.
    run, kinds = ["run", "proof"], ["doc_id", "text_no", "place"]
    order = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))
    name = F.xxhash64("doc_id", "text_no")
    least = spans.groupBy(run).agg(F.min(order).alias("first_doc"), F.min(name).alias("least_name"), F.max(name).alias("most_name"))
    repeated = store(least.where("least_name < most_name").select(*run, "first_doc"), "substring_runs")
    met = spans.select(*run, *kinds).join(repeated, run)
    covered = store(met.select(*run, *kinds, (order > F.col("first_doc")).alias("later")), "substring_met")
    # Different texts that share the run's smallest id: the smaller hash comes first.
    tied = covered.where("not later")
    firsts = tied.groupBy(run).agg(F.min("text_no").alias("first_no"), F.max("text_no").alias("last_no"))
    tied = tied.join(store(firsts.where("first_no < last_no"), "substring_same"), run).where("text_no > first_no")
    found_again = covered.where("later").select(*kinds).unionByName(tied.select(*kinds))
    gone = found_again.unionByName(spans.where("again").select(*kinds)).distinct()
    per_text = gone.groupBy("doc_id", "text_no").agg(F.collect_list("place").alias("gone"))
    per_text = store(per_text.withColumnsRenamed({"doc_id": "of_id", "text_no": "of_no"}), "substring_gone")
    joined = named.join(per_text, (F.col("text_no") == F.col("of_no")) & F.col("doc_id").eqNullSafe(F.col("of_id")), "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(_removed, "doc_id long, text string, n_removed long, removed_words long, spans array<struct<begin: long, end: long>>")
