"""Language-model scoring of whole texts: corpus-wide word counts, a recurrent model over frequent words, counts for all others.

Counts cover every training document. The most frequent words go to all tasks (a bounded table); the others are met by a
join of the words with their counts. The recurrent weights are fitted on every training document too, once each: documents are dealt
to rounds in turn, copies too, in a round every task goes over its own from the weights of the round before, and the tasks'
weights are averaged by their numbers of symbols.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import gru
from .scratch import as_bytes, store

#: Words of the recurrent model, and words whose counts are sent to all tasks.
MODEL_WORDS, SENT_WORDS = 4096, 1 << 18
#: Rounds of averaging, the rate of the first, and the pieces that a task's weights are passed on in: a task that averages holds pieces, not models.
ROUNDS, RATE, PIECES = 8, 0.03, 256
#: Bytes of texts that a task takes apart at once, and whole texts beyond.
_SLICE_BYTES = 1 << 25
#: Steps of the scale of counts per doubling.
_STEPS = 64
HELD_OUT = (7, 2)


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 by 7; a null id is the empty text and so in training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT[0] == HELD_OUT[1]


def _slices(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    """All rows in their order, about _SLICE_BYTES of the texts in column text_at at once."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        begins = np.flatnonzero(np.diff(sizes // _SLICE_BYTES, prepend=-1)).tolist()
        for begin, end in pairwise([*begins, batch.num_rows]):
            yield batch.slice(begin, end - begin)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, lower-cased in A-Z between ASCII white space, and the number of each text's; null has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))
    words, n = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    some = pc.not_equal(pc.binary_length(words), 0)  # a text without words is split into one empty word
    if len(words) and not pc.all(some).as_py():
        n = np.bincount(np.repeat(np.arange(len(n)), n), some.to_numpy(zero_copy_only=False), len(n)).astype(np.int64)
        words = words.filter(some)
    return words, n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of a task's training texts, a word once a slice; the empty word is the end of a text."""
    for batch in _slices(batches, 0):
        found = pc.value_counts(words_of(batch.column(0))[0])
        yield pa.RecordBatch.from_arrays([found.field("values").cast(pa.string()), found.field("counts")], ["word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([batch.num_rows], pa.int64())], ["word", "n"])


class Lexicon:
    """What a task takes texts apart with: the frequent words, those of the model first, their counts' logs and, last, the log of an unknown word's place."""

    def __init__(self, words: list[bytes], counts: np.ndarray, n_ends: int, n_model: int):
        self.words, self.logs, self.n_ends, self.n_model = pa.array(words, pa.binary()), np.append(np.log10(counts + 1.0), 0.0), n_ends, n_model

    def codes(self, words: pa.Array) -> np.ndarray:
        """The number of each word, -1 if it is not among them."""
        kind = pa.large_binary() if pa.types.is_large_string(words.type) else pa.binary()
        return pc.fill_null(pc.index_in(words.cast(kind), self.words.cast(kind)), -1).to_numpy(zero_copy_only=False)


_TAKEN = "row_no long, doc_id long, held_out boolean, n_tokens long, n_known long, n_other long, base_logs double, tail_logs double, missing array<string>, symbols binary, round_no int"


def _taken(sent, rounds: int):
    """Every row with its sums over words, the words that are not in the lexicon and the symbols of the model, two bytes each; training rows are dealt to rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon: Lexicon = sent.value
        part, m = TaskContext.get().partitionId(), lexicon.n_model
        row_no, seen = part << 40, part
        for batch in _slices(batches, 2):
            words, n = words_of(batch.column(2))
            rows, codes = batch.num_rows, lexicon.codes(words)
            text = np.repeat(np.arange(rows, dtype=np.int32), n)
            missing, in_model = codes < 0, (codes >= 0) & (codes < m)
            n_missing, n_in = (np.bincount(text[x], minlength=rows) for x in (missing, in_model))
            base, tail = (np.bincount(text, lexicon.logs[x], rows) for x in (codes, np.where(in_model, -1, codes)))
            symbols = np.full(len(codes) + rows, m + 1, "<u2")  # the end, where no word is put
            symbols[np.arange(len(codes)) + text] = np.where(in_model, codes, m)
            ends = np.cumsum(2 * (n + 1), dtype=np.int64)
            held = batch.column(1).to_numpy(zero_copy_only=False)
            nth = np.cumsum(~held)
            arrays = [
                pa.array(np.arange(rows) + row_no),
                *batch.columns[:2],
                *(pa.array(x, pa.int64()) for x in (n + 1, n - n_missing + (lexicon.n_ends > 0), n - n_in)),
                pa.array(base + math.log10(lexicon.n_ends + 1), pa.float64()),
                pa.array(tail, pa.float64()),  # of no words, bincount's is whole numbers
                pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n_missing]), pa.int32()), words.filter(pa.array(missing)).cast(pa.string())),
                pa.Array.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(symbols)]).cast(pa.binary()),
                pa.array(np.where(held, -1, (seen + nth - 1) % rounds), pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in _TAKEN.split(", ")])
            row_no, seen = row_no + rows, seen + int(nth[-1])

    return run


def _fitted(sent, rate: float):
    """A task's weights after a pass over its texts, in pieces, with the number of its symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = gru.from_vector(sent.value, gru.to_vector(sent.value))
        n, _ = gru.fit(model, (np.frombuffer(x, "<u2").astype(np.int64) for batch in batches for x in batch.column(0).to_pylist()), rate=rate)
        if n:
            pieces = [x.astype("<f4").tobytes() for x in np.array_split(gru.to_vector(model), PIECES)]
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(PIECES), pa.int32()), pa.array([part] * PIECES, pa.int32()), pa.array([n] * PIECES, pa.int64()), pa.array(pieces, pa.binary())], ["piece", "part", "n", "weights"]
            )

    return run


def _averaged(rows: pa.Table) -> pa.Table:
    """The mean of a piece over all tasks, in the order of the tasks."""
    rows = rows.sort_by("part")
    total, n = 0.0, 0
    for k, raw in zip(rows["n"].to_pylist(), rows["weights"].to_pylist(), strict=True):
        total, n = total + k * np.frombuffer(raw, "<f4").astype(np.float64), n + k
    return pa.table({"piece": rows["piece"][:1], "weights": pa.array([(total / n).astype("<f4").tobytes()], pa.binary())})


def fit_all(texts: DataFrame, model: gru.Gru, epochs: int = 1) -> gru.Gru:
    """The model after `epochs` passes over all texts (round_no, symbols), each in ROUNDS rounds; the rate falls from round to round.

    The driver gets one model a round, whatever the number of tasks.
    """
    context = texts.sparkSession.sparkContext
    for k in range(rounds := epochs * ROUNDS):
        parts = texts.where(F.col("round_no") == k % ROUNDS).select("symbols").mapInArrow(_fitted(context.broadcast(model), RATE * (1 - k / rounds)), "piece int, part int, n long, weights binary")
        means = parts.groupBy("piece").applyInArrow(_averaged, "piece int, weights binary").collect()
        if means:  # else the round has no texts
            model = gru.from_vector(model, np.concatenate([np.frombuffer(r["weights"], "<f4") for r in sorted(means)]))
    return model


_SCORED = "row_no long, doc_id long, held_out boolean, n_tokens long, n_known long, n_other long, base_logs double, model_logs double"


def _scored(sent) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: gru.Gru = sent.value
        for batch in batches:
            *same, tail, symbols = batch.columns
            logs = gru.score(model, [np.frombuffer(x, "<u2") for x in symbols.to_pylist()])
            yield pa.RecordBatch.from_arrays([*same, pa.array(logs / math.log(10) + tail.to_numpy(), pa.float64())], [x.split()[0] for x in _SCORED.split(", ")])

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", epochs: int = 1, model_words: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    Whole texts, null as empty: words lower-cased in A-Z between ASCII white space, then an end. base_score is the add-one unigram log10
    probability from the counts of all training rows; score that of the model: a gated recurrent network over the frequent words,
    `other` and end, where an other word has its add-one share among all other words. Rows that repeat count again. Without training
    rows, all words are unknown. An empty table gives an empty result. Any number of words can be in the model up to 65,000 and SENT_WORDS;
    whatever the number, words outside have their share and no row or word is left out.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    training = slim.where("not held_out").select("text")
    counts = training.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = store(counts.where("n > 0"), "lm_counts")
    n, v = (int(x or 0) for x in counts.agg(F.sum("n"), F.count("*")).first())
    # Words by a fine scale of their counts: the scale has a few thousand steps whatever the vocabulary, and as many of its upper steps are
    # sent as hold SENT_WORDS words at most. So each word comes to the driver once, and no task sorts or sends its own best.
    step = F.floor(F.log2("n") * _STEPS)
    words_only = counts.where("word <> ''")
    held, least = 0, 0
    for r in sorted(words_only.groupBy(step.alias("step")).count().collect(), reverse=True):
        if held + r["count"] > SENT_WORDS:
            least = r["step"] + 1
            break
        held += r["count"]
    sent = words_only.where(step >= least).toArrow()
    order = sorted(zip(sent["n"].to_pylist(), as_bytes(sent["word"].combine_chunks()), strict=True), key=lambda r: (-r[0], r[1]))
    n_ends = int(counts.where("word = ''").agg(F.sum("n")).first()[0] or 0)
    words, numbers = [w for _, w in order], np.array([k for k, _ in order], np.float64)
    m = min(model_words or MODEL_WORDS, len(words))
    n_other, v_other = n - n_ends - int(numbers[:m].sum()), max(0, v - m - 1)
    lexicon = Lexicon(words, numbers, n_ends, m)
    # Each text is taken apart once more, now by the words' numbers; the fit and the scoring read symbols.
    taken = store(slim.mapInArrow(_taken(spark.sparkContext.broadcast(lexicon), ROUNDS), _TAKEN), "lm_taken", by="round_no")
    model = fit_all(taken, gru.start(numbers[:m], n_other, n_ends), epochs)
    symbols = taken.select("row_no", "doc_id", "held_out", "n_tokens", "n_known", "n_other", "base_logs", "tail_logs", "symbols")
    rows = store(symbols.mapInArrow(_scored(spark.sparkContext.broadcast(model)), _SCORED), "lm_rows")
    rare = taken.select("row_no", F.explode("missing").alias("word"))
    rest = words_only.where(step < least)  # no other word can be missing
    found = rare.join(rest, "word").groupBy("row_no").agg(F.sum(F.log10(F.col("n") + 1.0)).alias("logs"), F.count("*").alias("found"))
    out = rows.join(found, "row_no", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_logs") + logs - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"),
        (F.col("model_logs") + logs - F.col("n_other") * math.log10(n_other + v_other + 1)).alias("score"),
    )
