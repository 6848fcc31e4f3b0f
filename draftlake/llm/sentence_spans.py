"""Repeated passages by sliding sentence spans: a run of consecutive sentences that stands earlier elsewhere goes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.llm.texts import FOLD, WORD, byte_chunks, pinned, powers, prefix_sums, scratch_table, span_hashes, word_table

SENTENCES, SPAN_WORDS, ALONE_WORDS = 2, 12, 12
LOWEST = -(1 << 63)
_STOP = np.isin(np.arange(256), [33, 46, 63])
_MARK = ~WORD[FOLD]


def sentences(data: np.ndarray, offsets: np.ndarray):
    """(text, first byte, first word, word hashes) of the sentences of a chunk.

    A sentence ends with . ! or ? before white space or any other byte that no word has, at a line's end or at the end of
    the text; it begins with its first word. What holds no word belongs to the sentence before it.
    """
    folded, starts, ends, bounds = word_table(data, offsets)
    stop = _STOP[data]
    stop[:-1] &= _MARK[data[1:]]
    cut = np.concatenate([np.flatnonzero(stop | (data == 10)), offsets[1:] - 1])
    cut = np.unique(cut)
    of = np.searchsorted(cut, starts)
    text = np.searchsorted(bounds, np.arange(len(starts)), side="right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (of[1:] != of[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return text[first], starts[first], first, span_hashes(prefix_sums(folded), starts, ends)


def spans(data: np.ndarray, offsets: np.ndarray, least: int = SENTENCES, words: int = SPAN_WORDS, alone: int = ALONE_WORDS):
    """(text, span hash, first sentence, last sentence) of the shortest runs, each once: from each sentence on and up to
    each sentence, as many sentences as it takes to have ``least`` sentences and ``words`` words, and each sentence of
    ``alone`` words by itself. Any longer run is covered by those inside it. Sentences are numbered within their text."""
    text, _, first, hashes = sentences(data, offsets)
    if not len(first):
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    after = np.append(first[1:], len(hashes))
    i = np.arange(len(first))
    last = np.maximum(i + least - 1, np.searchsorted(after, first + words))
    start = np.minimum(i - least + 1, np.searchsorted(first, after - words, side="right") - 1)
    single = after - first >= alone
    # With pairs, a run that reaches a sentence standing alone needs no hash from its other end.
    some = ~single if least <= 2 and alone >= words else np.ones(len(first), bool)
    i, last = np.concatenate([i[some], start[some], i[single]]), np.concatenate([last[some], i[some], i[single]])
    whole = (i >= 0) & (last < len(first))
    whole[whole] = text[last[whole]] == text[i[whole]]
    i, last = np.divmod(np.unique(i[whole] * len(first) + last[whole]), len(first))
    sums = _word_sums(hashes)
    base = np.searchsorted(text, np.arange(len(offsets) - 1))
    return text[i], span_hashes(sums, first[i], after[last]), i - base[text[i]], last - base[text[i]]


def _word_sums(hashes: np.ndarray) -> np.ndarray:
    up, _ = powers(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum((hashes | np.uint64(1)) * up[:len(hashes)], out=sums[1:])
    return sums


def remove_repeats(transcripts: DataFrame, id_col: str = "contest_id", text_col: str = "transcript",
                   least: int = SENTENCES, words: int = SPAN_WORDS, alone: int = ALONE_WORDS) -> DataFrame:
    """(id, n_sentences, n_removed, n_spans, kept, kept_sha256) per transcript, without repeated sentence runs.

    Runs of consecutive sentences (at least ``least``, and ``words`` words; or one of ``alone`` words) are compared by
    their lower-cased words; hashes of the shortest from and up to each sentence stand for all. Of
    equal runs the first stays: least id (equal ids: least row number; null ids first), then the earliest. Sentences
    covered by any other go, with what follows them up to the next sentence. Null text counts as empty; a text without
    a repeated run stays byte for byte. Ids are whole numbers; other columns are not read.
    """
    transcripts = pinned(transcripts.select(id_col, text_col))
    source = transcripts.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("_id"), F.col(id_col).alias("_own"),
                                F.monotonically_increasing_id().alias("_row"), F.col(text_col).alias("_text"))

    def found(batches):
        for batch in batches:
            ids, rows = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False), np.int64) for i in range(2))
            for at, end, data, offsets in byte_chunks(batch, "_text"):
                text, span, first, last = spans(data, offsets, least, words, alone)
                yield pa.RecordBatch.from_arrays([pa.array(span.view(np.int64)), pa.array(ids[text + at]), pa.array(rows[text + at]),
                                                  pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                                                 ["span", "id", "doc", "first", "last"])
    runs = source.select("_id", "_row", "_text").mapInArrow(found, "span long, id long, doc long, first int, last int")
    repeated = runs.groupBy("span").agg(F.min(F.struct("id", "doc", "first")).alias("least"), F.count("*").alias("n")) \
        .where("n > 1").drop("n")
    copies = runs.join(scratch_table(repeated, "repeated-spans"), "span") \
        .where(F.struct("id", "doc", "first") != F.col("least")).groupBy(F.col("doc").alias("_row")) \
        .agg(F.collect_list(F.struct("first", "last")).alias("_runs"))
    kind = transcripts.schema[id_col].dataType.simpleString()

    def remove(batches):
        for batch in batches:
            out = {k: [] for k in ("n_sentences", "n_removed", "n_spans", "kept", "kept_sha256")}
            own = batch.column(2)
            for at, end, data, offsets in byte_chunks(batch, "_text"):
                text, begin, _, _ = sentences(data, offsets)
                lo = np.searchsorted(text, np.arange(end - at + 1))
                for i in range(end - at):
                    whole = data[offsets[i]:offsets[i + 1]]
                    n, gone, spans_gone = int(lo[i + 1] - lo[i]), 0, 0
                    if own[at + i].is_valid:
                        change = np.zeros(n + 1, np.int64)
                        np.add.at(change, own[at + i].values.field(0).to_numpy(), 1)
                        np.add.at(change, own[at + i].values.field(1).to_numpy() + 1, -1)
                        removed = np.cumsum(change[:-1]) > 0
                        gone, spans_gone = int(removed.sum()), int(np.count_nonzero(np.diff(removed, prepend=False) & removed))
                        edges = np.concatenate([begin[lo[i]:lo[i + 1]] - offsets[i], [len(whole)]])
                        whole = whole[~np.repeat(np.concatenate([[False], removed]), np.diff(edges, prepend=0))]
                    kept = whole.tobytes()
                    for k, v in zip(out, (n, gone, spans_gone, kept.decode("utf-8", "replace"), hashlib.sha256(kept).hexdigest())):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(out[k], pa.int64()) for k in ("n_sentences", "n_removed", "n_spans")),
                 pa.array(out["kept"], pa.string()), pa.array(out["kept_sha256"], pa.string())], ["_own", *out])
    rows = source.select("_row", "_own", "_text").join(copies, "_row", "left").select("_own", "_text", "_runs")
    return rows.mapInArrow(remove, f"_own {kind}, n_sentences long, n_removed long, n_spans long, kept string, kept_sha256 string") \
        .withColumnRenamed("_own", id_col)
