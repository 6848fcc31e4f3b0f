"""Near copies by 64-bit similarity fingerprints: an inverted index of positional bytes, a tally of shared ones, verification.

Fingerprints that differ in 3 bits or fewer share at least 5 of their 8 bytes, each in its place. A list of one byte in
one place would hold 1/256 of a corpus, so lists are kept for four bytes at a time: of the 14 quadruples of places below,
every set of 5 places contains one, so each pair to be found meets in a list. Pairs that meet are tallied over
all 8 places, those with fewer than 5 shared bytes go, and the rest is verified bit by bit.

Lists of more than ``LIST`` fingerprints are never compared pair by pair. There two fingerprints 1 or 2 bits apart
meet in a point one bit from each, and two that are 3 bits apart meet in a point one bit from one and two from the other.
Everything within one bit of a point is linked to the least of them, which keeps the groups and takes linear work.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.llm.components import components
from draftlake.llm.texts import one_row, scratch_table

WORDS, SEED = 3, 42
PLACES, DIFFER = 8, 3
SHARED = PLACES - DIFFER
LIST = 64
PIECE, BLOCK = 1 << 20, 1 << 17
# Quadruples of places that cancel out: a Steiner system, every three places lie in exactly one of them.
QUADS = [q for q in combinations(range(PLACES), 4) if q[0] ^ q[1] ^ q[2] ^ q[3] == 0]
_SPACE = re.compile(rb"[ \t-\r]")


def _pieces(data: bytes):
    """The text cut at white space into pieces of about ``PIECE`` bytes; no word is cut."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def _tally(words: list[bytes], n: int, ones: np.ndarray) -> int:
    """Add the set bits of the hashes of every run of n words to ``ones``; the number of runs."""
    joined = b" ".join(words)
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1) - 1
    starts, ends = ends - length, ends[n - 1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(ends), BLOCK):
        a, b = starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist()
        hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(a, b)), np.uint64, len(b))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return len(ends)


def fingerprint(text: bytes, n: int = WORDS) -> int:
    """Unsigned 64-bit fingerprint: bits set in over half of the XXH64 hashes of all runs of ``n`` words, repeats included.

    Words are what white space (space, tab to carriage return) separates, A-Z folded, joined by one space. A text of
    fewer words is one run, one of none has fingerprint 0.
    """
    ones, runs, held = np.zeros(64, np.int64), 0, []
    for piece in _pieces(text.lower()):
        words = held + piece.split()
        if len(words) >= n:
            runs += _tally(words, n, ones)
        held = words[max(0, len(words) - n + 1):]
    if not runs and held:
        runs = _tally(held, len(held), ones)
    return int(np.packbits(2 * ones > runs).view(np.uint64)[0])


def _signed(n: int):
    def sign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                prints = [fingerprint((t.as_py() or "").encode("utf-8", "surrogatepass"), n) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))],
                                                 ["_id", "_print"])
    return sign


def shared_places(a: str, b: str) -> F.Column:
    """How many of the 8 bytes of two fingerprints are equal in their places."""
    same = F.lit(0)
    for i in range(PLACES):
        same = same + F.when(F.col(a).bitwiseXOR(F.col(b)).bitwiseAND(F.lit(_signed_long(0xFF << 8 * i))) == 0, 1).otherwise(0)
    return same


def _signed_long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def positional_lists(prints: DataFrame) -> DataFrame:
    """(_quad, _bytes, _print, _n): lists of two or more of the distinct fingerprints that share four bytes in place."""
    masks = [_signed_long(sum(0xFF << 8 * i for i in q)) for q in QUADS]
    entries = prints.select("_print", F.posexplode(F.array(*(F.col("_print").bitwiseAND(F.lit(m)) for m in masks))).alias("_quad", "_bytes"))
    several = entries.groupBy("_quad", "_bytes").agg(F.count("*").alias("_n")).where("_n > 1")
    return entries.join(several, ["_quad", "_bytes"]).select("_quad", "_bytes", "_print", "_n")


def _around(distance: int):
    """(_point, _print): every value ``distance`` bits or fewer from each fingerprint."""
    flips = [0, *(1 << i for i in range(64))]
    if distance == 2:
        flips += [(1 << i) | (1 << j) for i, j in combinations(range(64), 2)]
    flips = np.array(flips, np.uint64).view(np.int64)

    def points(batches):
        for batch in batches:
            prints = batch.column(0).to_numpy()
            for at in range(0, len(prints), 100):
                part = prints[at:at + 100]
                yield pa.RecordBatch.from_arrays([pa.array((part[:, None] ^ flips).ravel()), pa.array(np.repeat(part, len(flips)))],
                                                 ["_point", "_print"])
    return points


def crowded_links(lists: DataFrame) -> DataFrame:
    """(a, b): links that connect what lists beyond ``LIST`` connect, every one of them between fingerprints within 3 bits.

    First everything within a bit of a common point. Pairs 3 bits apart that are in different groups then meet by the
    wider surroundings of the one that is not in its list's largest group.
    """
    prints = scratch_table(lists.select("_print").distinct(), "crowded")
    near = scratch_table(prints.mapInArrow(_around(1), "_point long, _print long"), "points")
    hubs = scratch_table(near.groupBy("_point").agg(F.min("_print").alias("_hub"), F.count("*").alias("_n")), "hubs")
    close = near.join(hubs.where("_n > 1"), "_point").where("_print != _hub").select(F.col("_print").alias("a"), F.col("_hub").alias("b"))
    close = scratch_table(close.distinct(), "close-links")
    groups = components(close, "a", "b").withColumnRenamed("node", "_print")
    grouped = scratch_table(lists.join(groups, "_print", "left").withColumn("_group", F.coalesce("component", "_print")), "grouped-lists")
    sizes = grouped.groupBy("_quad", "_bytes", "_group").agg(F.count("*").alias("_size"))
    largest = sizes.groupBy("_quad", "_bytes").agg(F.max_by("_group", F.struct("_size", "_group")).alias("_largest"))
    others = grouped.join(largest, ["_quad", "_bytes"]).where("_group != _largest").select("_print").distinct()
    wide = others.mapInArrow(_around(2), "_point long, _print long").join(hubs, "_point").where("_print != _hub")
    return close.union(wide.select(F.col("_print").alias("a"), F.col("_hub").alias("b")).distinct())


def fingerprint_links(prints: DataFrame, most: int = LIST) -> DataFrame:
    """(a, b) links between the distinct fingerprints in ``_print``, which connect exactly those 3 bits or fewer apart."""
    lists = scratch_table(positional_lists(prints), "positional-lists")
    short = lists.where(F.col("_n") <= most)
    met = short.select("_quad", "_bytes", F.col("_print").alias("a")).join(short.select("_quad", "_bytes", F.col("_print").alias("b")), ["_quad", "_bytes"])
    found = met.where(F.col("a") < F.col("b")).where(shared_places("a", "b") >= SHARED) \
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DIFFER).select("a", "b").distinct()
    long = lists.where(F.col("_n") > most)
    return found.union(crowded_links(long)) if one_row(long.limit(1), F.count("*"))[0] else found


def near_copies(transcripts: DataFrame, id_col: str = "contest_id", text_col: str = "transcript", n: int = WORDS,
                most: int = LIST) -> DataFrame:
    """One row per transcript: its fingerprint (16 lowercase hex digits) and component_id.

    Transcripts are linked when their fingerprints differ in 3 bits or fewer; component_id is the smallest id that links
    reach, the own one included. Null text counts as empty; texts without words have fingerprint 0 and are linked like any
    other. A null id takes part, but is component_id only where no row of the group has an id. Repeated rows count as
    rows, extra columns are not read, no rows give no rows. No list is gathered in a task, no pair of equal
    fingerprints is made, and ``most`` changes the way a list is worked through, never the result.
    """
    kind = transcripts.schema[id_col].dataType.simpleString()
    source = transcripts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    signed = scratch_table(source.mapInArrow(_signed(n), f"_id {kind}, _print long"), "fingerprints")
    prints = scratch_table(signed.groupBy("_print").agg(F.min("_id").alias("_least"), F.count("*").alias("_n")), "distinct-fingerprints")
    groups = components(fingerprint_links(prints.select("_print"), most), "a", "b").withColumnRenamed("node", "_print")
    named = prints.join(groups, "_print", "left").where("_n > 1 or component is not null") \
        .withColumn("component", F.coalesce("component", "_print"))
    named = scratch_table(named, "named-fingerprints")
    least = scratch_table(named.groupBy("component").agg(F.min("_least").alias("component_id")), "least-ids")
    known = scratch_table(named.join(least, "component").select("_print", "component_id"), "component-ids")
    return signed.join(known, "_print", "left").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "_id").alias("component_id"))
