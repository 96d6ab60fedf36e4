"""Mixture-controlled packing: deficit round-robin over source queues, worked out in closed form.

Every source is a queue of its documents' tokens. In round r a queue sends floor((r+1)p/R) - floor(rp/R) tokens until it is empty, p/R its
quantum: what it may send plus the deficit it carries, so after any round it is within a token of its target, across windows and
partitions. A round is a window's worth of tokens. Without weights p is the queue's size and R the number of rounds: all queues end
together. The rounds laid end to end are one stream that is cut every `width` tokens. Because the quanta have a closed form, a
document finds its pieces from its place in its queue alone: the only thing partitions exchange is a sum per partition and source.

A round of many queues would be dear to work out, so more than FAN_OUT of them make a tree: FAN_OUT groups of like sizes take turns
in the stream, and the queues of a group take turns, by the same schedule, in what the group sends.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import frugal, store
from .tokens import encoder

WIDTH, END_ID = 1024, 0
#: Queues or groups that take turns at a node of the tree.
FAN_OUT = 256


def muldiv(a: np.ndarray, b: int, m: int) -> np.ndarray:
    """floor(a * b / m) for 0 <= b <= m, exact: where the product is too large b goes in digits of 16 bits, for a <= m < 2**46."""
    if int(a.max(initial=0)) * b < 1 << 62:
        return a * b // m
    quotient, rest = np.zeros_like(a), np.zeros_like(a)
    for shift in (32, 16, 0):
        rest = (rest << 16) + a * (b >> shift & 0xFFFF)
        quotient = (quotient << 16) + rest // m
        rest %= m
    return quotient


class Schedule:
    """Where queues' tokens come to stand in the stream of all queues. weights: target proportions while queues last; else their sizes."""

    def __init__(self, sizes: list[int], width: int = WIDTH, weights: list[int] | None = None):
        self.sizes, self.width, self.total = sizes, width, sum(sizes)
        if weights is None:
            self.quanta, self.per = sizes, max(1, -(-self.total // width))
        else:
            self.quanta, self.per = [width * w for w in weights], max(1, sum(weights))

    def sent(self, queue: int, rounds: np.ndarray) -> np.ndarray:
        """Tokens that the queue has sent before the round."""
        whole, part = divmod(self.quanta[queue], self.per)
        return np.minimum(rounds * whole + muldiv(rounds, part, self.per), self.sizes[queue])

    def rounds_of(self, queue: int, first: int, last: int) -> tuple[int, int]:
        """The rounds that send tokens first and last of the queue."""
        p, r = self.quanta[queue], self.per
        return -(-(first + 1) * r // p) - 1, -(-(last + 1) * r // p) - 1

    def turns(self, queues: list[int], firsts: list[int], lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, its token where a turn's share of it begins, that token's place in the stream), in the documents' order.

        Documents are tokens first .. first + length - 1 of their queues; lengths are over 0.
        """
        ends = [self.rounds_of(*x) for x in zip(queues, firsts, (f + n - 1 for f, n in zip(firsts, lengths, strict=True)), strict=True)]
        counts = np.array([b - a + 1 for a, b in ends], np.int64)
        doc = np.repeat(np.arange(len(ends)), counts)
        rounds = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(np.array([a for a, _ in ends], np.int64), counts)
        queue, first = np.array(queues, np.int64)[doc], np.array(firsts, np.int64)
        by_queue = np.argsort(queue, kind="stable")
        edges = np.searchsorted(queue[by_queue], np.arange(len(self.sizes) + 1))
        rounds, begin, stop, at = rounds[by_queue], np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
        for q in range(len(self.sizes)):
            own, later = slice(edges[q], edges[q + 1]), slice(edges[q + 1], None)
            if len(doc) > edges[q + 1]:
                at[later] += self.sent(q, rounds[later] + 1)
            now = self.sent(q, rounds[: edges[q + 1]])
            at[: edges[q + 1]] += now
            begin[own], stop[own] = now[own], self.sent(q, rounds[own] + 1)
        back = np.empty_like(by_queue)
        back[by_queue] = np.arange(len(doc))
        begin, stop, at = begin[back], stop[back], at[back]
        sends = stop > begin
        doc, begin, at = doc[sends], begin[sends], at[sends]
        late = np.maximum(first[doc] - begin, 0)  # a document that begins within a quantum
        return doc, begin + late - first[doc], at + late

    def pieces(self, queues: list[int], firsts: list[int], lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, its token where a piece begins, the piece's length, its place in the stream), cut at the sequences' edges."""
        doc, begin, at = self.turns(queues, firsts, lengths)
        stop = np.array(lengths, np.int64)
        doc, begin, at = self._cut_at(doc, begin, at, stop)
        return doc, begin, self._sizes(doc, begin, stop), at

    @staticmethod
    def _sizes(doc: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return np.where(np.r_[doc[1:] != doc[:-1], True], stop[doc], np.r_[begin[1:], 0]) - begin if len(doc) else begin

    def _cut_at(self, doc: np.ndarray, begin: np.ndarray, at: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same pieces, cut where the stream reaches a new sequence."""
        cuts = (at + self._sizes(doc, begin, stop) - 1) // self.width - at // self.width
        k = np.repeat(np.arange(len(at)), cuts + 1)
        nth = np.arange(len(k)) - np.repeat(np.cumsum(cuts + 1) - (cuts + 1), cuts + 1)
        to = np.where(nth > 0, (at[k] // self.width + nth) * self.width, at[k])
        doc, begin, at = doc[k], begin[k] + to - at[k], to
        start, parts = self.tail()
        for edge in (start + np.cumsum(parts)[:-1]).tolist() if len(parts) > 1 else []:
            over = np.flatnonzero((at < edge) & (at + self._sizes(doc, begin, stop) > edge))
            shift = edge - at[over]
            doc, begin, at = np.insert(doc, over + 1, doc[over]), np.insert(begin, over + 1, begin[over] + shift), np.insert(at, over + 1, at[over] + shift)
        return doc, begin, at

    def tail(self) -> tuple[int, list[int]]:
        """Where the last, short sequence begins, and the powers of two it is cut into, so that it needs no padding."""
        left = self.total % self.width
        return self.total - left, [1 << k for k in reversed(range(left.bit_length())) if left >> k & 1]

    def sequence(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of places in the stream."""
        start, parts = self.tail()
        ids, offsets = at // self.width, at % self.width
        edges = start + np.cumsum([0, *parts])
        late = at >= start
        if late.any():
            k = np.searchsorted(edges, at[late], side="right") - 1
            ids[late], offsets[late] = start // self.width + k, at[late] - edges[k]
        return ids, offsets


class Tree(Schedule):
    """A schedule of any number of queues: those whose numbers are equal modulo FAN_OUT make a group, a queue of the node above."""

    def __init__(self, sizes: list[int], width: int = WIDTH, weights: list[int] | None = None):
        groups = [range(k, len(sizes), FAN_OUT) for k in range(FAN_OUT)]
        share = [sum((weights or sizes)[k] for k in g) for g in groups]
        # What a group sends in a round of this node is a round of its own.
        self.groups = [schedule([sizes[k] for k in g], max(1, width * s // sum(share)), weights and [weights[k] for k in g]) for g, s in zip(groups, share, strict=True)]
        super().__init__([g.total for g in self.groups], width, weights and share)

    def turns(self, queues: list[int], firsts: list[int], lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        members: dict[int, list[int]] = {}
        for k, q in enumerate(queues):
            members.setdefault(q % FAN_OUT, []).append(k)
        docs, begins, groups, places = [], [], [], []
        for g, own in members.items():
            doc, begin, at = self.groups[g].turns([queues[k] // FAN_OUT for k in own], [firsts[k] for k in own], [lengths[k] for k in own])
            docs.append(np.array(own)[doc])
            begins.append(begin)
            groups.append(np.full(len(doc), g))
            places.append(at)
        doc, begin, group, place = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (docs, begins, groups, places))
        order = np.lexsort((begin, doc))
        doc, begin, group, place = doc[order], begin[order], group[order], place[order]
        size = self._sizes(doc, begin, np.array(lengths, np.int64))
        part, start, at = super().turns(group.tolist(), place.tolist(), size.tolist())
        return doc[part], begin[part] + start, at


def schedule(sizes: list[int], width: int = WIDTH, weights: list[int] | None = None) -> Schedule:
    return (Schedule if len(sizes) <= FAN_OUT else Tree)(sizes, width, weights)


def _tokenized(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, sums = encoder(path).ids, TaskContext.get().partitionId(), {}
        end = np.array([END_ID], "<u2").tobytes()
        for batch in batches:
            sources = batch.column(1).to_pylist()
            ids = [ids_of(x or "") + end for x in batch.column(2).to_pylist()]
            before = []
            for source, x in zip(sources, ids, strict=True):
                before.append(sums.get(source, 0))
                sums[source] = before[-1] + len(x) // 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s is None for s in sources], pa.bool_()), pa.array([s or "" for s in sources], pa.string()), pa.array([part] * len(ids), pa.int32()), pa.array(before, pa.int64()), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "no_source", "source", "part", "before", "doc_tokens", "ids"],
            )

    return run


def _cut(plan: Schedule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = zlib.crc32
        for batch in batches:
            if not batch.num_rows:
                continue
            queues, firsts, lengths, ids = (batch.column(k).to_pylist() for k in range(1, 5))
            doc, start, length, at = plan.pieces(queues, firsts, lengths)
            sums, of, wide = [], -1, b""
            for k, a, b in zip(doc.tolist(), (start * 4).tolist(), ((start + length) * 4).tolist(), strict=True):
                if k != of:
                    of, wide = k, memoryview(np.frombuffer(ids[k], "<u2").astype("<u4").tobytes())
                sums.append(crc(wide[a:b]))
            sequence, offset = plan.sequence(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(sums, pa.int64()), pa.array(np.array(lengths, np.int64)[doc]), pa.array(sequence), pa.array(offset)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, tokenizer_path: str, width: int = WIDTH, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: Mapping[str | None, int] | None = None) -> DataFrame:
    """Pieces of documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of its text and a final 0 (a null or empty text: 0 alone). Every sequence is full, but for the last
    ones, whose lengths are powers of two. Targets are the sources' shares of all tokens or, by weights (whole numbers over 0; sources not
    named: 1), proportions that hold while the sources last: what is left then goes on without the ended ones. A null source is a
    source. Rows that repeat a document are documents of their own. An empty table gives an empty result. The sizes of all sources,
    two numbers each, go to the driver and every task: some ten million sources are the bound.
    """
    spark = docs.sparkSession
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    rows = store(found.mapInArrow(frugal(_tokenized(tokenizer_path)), "doc_id long, no_source boolean, source string, part int, before long, doc_tokens long, ids binary"), "pack_rows")
    sums = store(rows.groupBy("no_source", "source", "part").agg(F.sum("doc_tokens").alias("tokens")), "pack_sums")
    # Queues by size; only this table, a row per source, is ordered as a whole.
    per = sums.groupBy("no_source", "source").agg(F.sum("tokens").alias("tokens"))
    by_size = Window.orderBy(F.col("tokens").desc(), "no_source", "source")
    per = store(per.withColumn("queue", F.row_number().over(by_size) - 1), "pack_queues")
    sources = sorted(per.collect(), key=lambda r: r["queue"])
    if not sources:
        return spark.createDataFrame([], "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    plan = schedule([int(r["tokens"]) for r in sources], width, weights and [weights.get(None if r["no_source"] else r["source"], 1) for r in sources])
    in_queue = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.join(per.select("no_source", "source", "queue"), ["no_source", "source"]).withColumn("first", F.coalesce(F.sum("tokens").over(in_queue), F.lit(0)))
    placed = store(placed.select("no_source", "source", "part", "queue", "first"), "pack_places")
    ready = rows.join(placed, ["no_source", "source", "part"]).select("doc_id", "queue", (F.col("first") + F.col("before")).alias("first"), "doc_tokens", "ids")
    return ready.mapInArrow(frugal(_cut(plan)), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
