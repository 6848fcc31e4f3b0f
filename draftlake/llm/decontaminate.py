"""Benchmark passages in transcripts, found by a generalised suffix automaton over words."""

from __future__ import annotations

from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.llm.texts import byte_chunks, one_row, pinned, scratch_table, word_hashes

WINDOW = 10
BLOCK_WORDS = 200_000


class WordAutomaton:
    """Suffix automaton of all items of a block, over word numbers.

    ``grams[state]`` holds the items with the window that ends a match in that state, ``short[state]`` the items below
    the window length that end there as a whole.
    """

    def __init__(self, items: list[tuple[object, np.ndarray]], window: int):
        self.window = window
        self.vocabulary = np.unique(np.concatenate([w for _, w in items])) if items else np.zeros(0, np.uint64)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        numbered = [(i, np.searchsorted(self.vocabulary, w).tolist()) for i, w in items]
        for _, words in numbered:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.window_state = self._ancestors()
        self.grams: dict[int, set] = {}
        self.short: dict[int, list] = {}
        self.least = window
        for item, words in numbered:
            state, length = 0, 0
            for w in words:
                state, length = self.step(state, length, w)
                if length >= window:
                    self.grams.setdefault(self.window_state[state], set()).add(item)
            if 0 < len(words) < window:
                self.short.setdefault(state, []).append((len(words), item))
                self.least = min(self.least, len(words))
        self.nearest = self._nearest()

    def _state(self, size: int, link: int, after: dict) -> int:
        self.next.append(after)
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        clone = self._state(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.size[q] == self.size[last] + 1 else self._split(last, w, q)
        new, p = self._state(self.size[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, w, q)
        return new

    def _ancestors(self) -> list[int]:
        """For each state long enough, the state on its suffix links that holds the suffix of window length."""
        out = [0] * len(self.size)
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            if self.size[s] >= self.window:
                out[s] = s if self.size[self.link[s]] < self.window else out[self.link[s]]
        return out

    def _nearest(self) -> list[int]:
        """For each state the nearest state on its suffix links, itself first, at which a short item ends, or 0."""
        out = [0] * len(self.size)
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            out[s] = s if s in self.short else out[self.link[s]]
        return out

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        """The state and length of the longest match that ends with word w."""
        following = self.next
        while state and w not in following[state]:
            state = self.link[state]
            length = self.size[state]
        if w in following[state]:
            return following[state][w], length + 1
        return 0, 0

    def scan(self, words: list[int], at: int, hit: np.ndarray, found: set) -> None:
        """Mark the words of one run, which starts at word ``at``, and collect the items."""
        state = length = 0
        for i, w in enumerate(words, at):
            state, length = self.step(state, length, w)
            if length >= self.window:
                hit[i - self.window + 1:i + 1] = True
                found |= self.grams[self.window_state[state]]
            s = self.nearest[state]
            while s:
                for n, item in self.short[s]:
                    if n <= length:
                        hit[i - n + 1:i + 1] = True
                        found.add(item)
                s = self.nearest[self.link[s]]


def _words_of(batch: pa.RecordBatch, column: str):
    """(row, word hashes, byte starts, byte ends, bytes of the text) of each text."""
    for at, end, data, offsets in byte_chunks(batch, column):
        hashes, bounds, starts, ends = word_hashes(data, offsets)
        for i in range(at, end):
            a, b = bounds[i - at], bounds[i - at + 1]
            yield i, hashes[a:b], starts[a:b] - offsets[i - at], ends[a:b] - offsets[i - at], \
                data[offsets[i - at]:offsets[i - at + 1]]


def automata(items: DataFrame, key_col: str = "ability_key", text_col: str = "description", window: int = WINDOW,
             block_words: int = BLOCK_WORDS):
    """Automata of the items, one per block of about ``block_words`` words.

    Long items are cut into parts that overlap by window - 1 words, so every window lies in a part and a block stays
    bounded. Only one block at a time is brought to the driver.
    """
    def parts(batches):
        for batch in batches:
            keys, rows = batch.column(0).to_pylist(), []
            for i, words, _, _, _ in _words_of(batch, "_text"):
                for p in range(0, max(1, len(words) - window + 1), block_words // 8):
                    part = words[p:p + block_words // 8 + window - 1]
                    rows.append((keys[i], p, len(part), part.astype("<u8").tobytes()))
            yield pa.RecordBatch.from_pydict(dict(zip(("key", "part", "n", "words"), map(list, zip(*rows)))) if rows else
                                             {"key": [], "part": [], "n": [], "words": []},
                                             pa.schema([("key", pa.string()), ("part", pa.int64()), ("n", pa.int64()),
                                                        ("words", pa.binary())]))

    cut = items.select(F.col(key_col).cast("string").alias("_key"), F.col(text_col).alias("_text")).where("_key is not null") \
        .mapInArrow(parts, "key string, part long, n long, words binary").where("n > 0")
    blocks = -(-(one_row(cut, F.sum("n"))[0] or 0) // block_words)
    for b in range(blocks):
        rows = cut.where(F.pmod(F.xxhash64("key", "part"), F.lit(blocks)) == b).collect()
        yield WordAutomaton([(r["key"], np.frombuffer(r["words"], "<u8")) for r in rows], window)
    if not blocks:
        yield WordAutomaton([], window)


def _hits(automaton: WordAutomaton, words: np.ndarray):
    """(hit words, items) of one text."""
    hit, found = np.zeros(len(words), bool), set()
    if len(automaton.vocabulary) and len(words):
        at = np.searchsorted(automaton.vocabulary, words)
        at[at == len(automaton.vocabulary)] = 0
        known = automaton.vocabulary[at] == words
        edges = np.flatnonzero(np.diff(known, prepend=False, append=False))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= automaton.least:
                automaton.scan(at[a:b].tolist(), int(a), hit, found)
    return hit, found


def _spans(hit: np.ndarray):
    edges = np.flatnonzero(np.diff(hit, prepend=False, append=False))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


_FOUND = "_row long, n_words long, spans array<struct<first:long,after:long>>, items array<string>"


def benchmark_hits(transcripts: DataFrame, items: DataFrame, id_col: str = "contest_id", text_col: str = "transcript",
                   key_col: str = "ability_key", item_col: str = "description", window: int = WINDOW,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, n_words, spans of hit words, items) per transcript against ability descriptions (or any stated items).

    A window is ``window`` consecutive words of an item, or a whole shorter item; a transcript word inside any
    occurrence of a window is hit. Words are lower-cased (A-Z) runs of letters, digits and characters beyond ASCII.
    Null and empty texts have no words; items without words or without a key are left out; repeated items and rows each
    count as what they are. The transcripts are read once per block of items, and never shuffled for a single block.
    """
    kind = transcripts.schema[id_col].dataType.simpleString()
    passes = []
    source = pinned(transcripts.select(id_col, text_col)).select(
        F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(text_col).alias("_text"))
    for automaton in automata(items, key_col, item_col, window, block_words):
        shared = transcripts.sparkSession.sparkContext.broadcast(automaton)

        def scan(batches, shared=shared):
            out = pa.struct([("first", pa.int64()), ("after", pa.int64())])
            for batch in batches:
                n_words, spans, found = [], [], []
                for _, words, _, _, _ in _words_of(batch, "_text"):
                    hit, got = _hits(shared.value, words)
                    n_words.append(len(words))
                    spans.append([{"first": a, "after": b} for a, b in _spans(hit)])
                    found.append(sorted(got))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(out)),
                     pa.array(found, pa.list_(pa.string()))], ["_id", "_row", "n_words", "spans", "items"])
        passes.append(source.mapInArrow(scan, f"_id {kind}, {_FOUND}"))
    if len(passes) == 1:
        return passes[0].select(F.col("_id").alias(id_col), "n_words", "spans", "items")
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p)
    merged = every.groupBy("_row").agg(
        F.first("_id").alias(id_col), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("_all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = F.aggregate("_all", F.array().cast("array<struct<first:long,after:long>>"), lambda done, s: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["after"] >= s["first"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["first"].alias("first"),
            F.greatest(F.element_at(done, -1)["after"], s["after"]).alias("after"))))
        ).otherwise(F.concat(done, F.array(s))))
    return merged.select(id_col, "n_words", F.when(F.size("_all") > 0, joined).otherwise(F.col("_all")).alias("spans"), "items")


def hit_words() -> F.Column:
    """Number of hit words of a row of benchmark_hits."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])


def without_benchmark(transcripts: DataFrame, items: DataFrame, text_col: str = "transcript",
                      key_col: str = "ability_key", item_col: str = "description", window: int = WINDOW,
                      coverage: float = 0.5, block_words: int = BLOCK_WORDS, blocks_at_once: int = 16,
                      length_col: str | None = None) -> DataFrame:
    """The transcripts, all columns, with every hit span cut out; those with more than ``coverage`` of their words hit go.

    A span reaches from the first byte of its first word to the last byte of its last word. Clean texts stay byte for
    byte, null and empty ones too; extra columns pass through. A task holds ``blocks_at_once`` blocks of items at most:
    with more of them the transcripts are read once for each so many, the hit spans of the rows that have some are
    written aside, and all are cut at the end. No item is left out, and the result is the same.
    ``length_col``, if given, takes the number of characters of each text that was cut.
    """
    spark, every = transcripts.sparkSession, automata(items, key_col, item_col, window, block_words)
    turn, after = list(islice(every, blocks_at_once)), next(every, None)
    if after is None:
        shared = [spark.sparkContext.broadcast(a) for a in turn]

        def hits_of(_batch, _i, words):
            hit = np.zeros(len(words), bool)
            for s in shared:
                hit |= _hits(s.value, words)[0]
            return hit
        return transcripts.mapInArrow(_cutting(transcripts, text_col, length_col, coverage, hits_of), transcripts.schema)

    row = next(name for k in count() if (name := f"_hit_row{k}") not in {c.lower() for c in transcripts.columns})
    numbered = pinned(transcripts).withColumn(row, F.monotonically_increasing_id())
    source, found, every = numbered.select(F.col(row).alias("_row"), F.col(text_col).alias("_text")), None, chain([after], every)
    while turn:
        shared = [spark.sparkContext.broadcast(a) for a in turn]
        rows = scratch_table(source.mapInArrow(_spans_of(shared), "_row long, _spans array<long>"), "benchmark-spans")
        found = rows if found is None else found.union(rows)
        for s in shared:
            s.destroy()
        turn = list(islice(every, blocks_at_once))
    spans = found.groupBy("_row").agg(F.flatten(F.collect_list("_spans")).alias(f"{row}_spans")).withColumnRenamed("_row", row)
    joined = numbered.join(spans, row, "left").select(*numbered.columns[:-1], f"{row}_spans")
    last = len(joined.columns) - 1

    def stored(batch, i, words):
        hit, places = np.zeros(len(words), bool), batch.column(last)[i]
        if places.is_valid:
            for a, b in np.asarray(places.values, np.int64).reshape(-1, 2):
                hit[a:b] = True
        return hit
    return joined.mapInArrow(_cutting(transcripts, text_col, length_col, coverage, stored), transcripts.schema)


def _spans_of(shared: list):
    """Hit spans (first and after, one behind the other) of the rows that have some."""
    def scan(batches):
        for batch in batches:
            at, spans = [], []
            for i, words, _, _, _ in _words_of(batch, "_text"):
                hit = np.zeros(len(words), bool)
                for s in shared:
                    hit |= _hits(s.value, words)[0]
                if hit.any():
                    at.append(i)
                    spans.append([place for span in _spans(hit) for place in span])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(spans, pa.list_(pa.int64()))],
                                             ["_row", "_spans"])
    return scan


def _cutting(transcripts: DataFrame, text_col: str, length_col: str | None, coverage: float, hits_of):
    """Cuts the words that ``hits_of(batch, row, words)`` marks; columns beyond those of the transcripts are left out."""
    where, width = transcripts.columns.index(text_col), len(transcripts.columns)
    length = transcripts.columns.index(length_col) if length_col else None

    def clean(batches):
        for batch in batches:
            texts, keep = batch.column(where).to_pylist(), np.ones(batch.num_rows, bool)
            lengths = batch.column(length).to_pylist() if length is not None else None
            changed = False
            for i, words, starts, ends, data in _words_of(batch, text_col):
                hit = hits_of(batch, i, words)
                if hit.any():
                    if hit.sum() > coverage * len(words):
                        keep[i] = False
                    raw, at = [], 0
                    for a, b in _spans(hit):
                        raw.append(data[at:int(starts[a])].tobytes())
                        at = int(ends[b - 1])
                    texts[i] = b"".join([*raw, data[at:].tobytes()]).decode("utf-8", "replace")
                    if lengths is not None:
                        lengths[i] = len(texts[i])
                    changed = True
            columns, schema = list(batch.columns)[:width], pa.schema(list(batch.schema)[:width])
            if changed:
                columns[where] = pa.array(texts, schema.field(where).type)
                if lengths is not None:
                    columns[length] = pa.array(lengths, schema.field(length).type)
            batch = pa.RecordBatch.from_arrays(columns, schema=schema)
            yield batch.filter(pa.array(keep)) if changed else batch
    return clean
