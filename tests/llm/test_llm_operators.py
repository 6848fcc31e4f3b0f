"""Every operator on nulls, empty, long, tied and repeated rows, against brute force."""

import hashlib
import re
import random
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from draftlake.llm import (block_names, components, decontaminate, html_runs, longest_previous, packing, pairwise_quality,
                           pseudo_likelihood, sentence_spans, texts, token_files, tokens, weighted_minhash)
from .conftest import edge_rows

FILE = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def fold(text):
    return (text or "").encode().lower()


def words(text):
    return [w.decode("utf-8") for w in WORD.findall(fold(text))]


def low(i):
    return -1 if i is None else i


def test_tokens_equal_the_library():
    plain = Tokenizer.from_file(FILE)
    every = [t or "" for _, t in edge_rows()] + ["don't we'll ÀÉ ﬁ ΣΑΣ\x85x", "á b"]
    for text, ids in zip(every, tokens.encoder(FILE).encode_many(every)):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_chat_becomes_transcripts(spark):
    chat = spark.createDataFrame([(1, 5, "a", "gg"), (1, 2, "b", "hi"), (2, 1, "c", None)], "contest_id long, time int, unit string, key string")
    assert {r.contest_id: r.transcript for r in texts.transcripts(chat).collect()} == {1: "hi\ngg", 2: ""}


def test_exact_copies(transcripts, nothing):
    got = block_names.exact_copies(transcripts, block_bytes=64).collect()
    groups = {}
    for c, t in edge_rows():
        groups.setdefault(fold(t), []).append(c)
    assert len(got) == len(edge_rows())
    exp = Counter((c, max(ids, key=low), len(ids), hashlib.sha256(t).hexdigest()) for t, ids in groups.items() for c in ids)
    assert Counter((r.contest_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == exp
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.contest_id == r.keep_id for r in got if r.kept)
    assert block_names.exact_copies(nothing).count() == 0


def brute_hits(text, items, window):
    w, hit, found = words(text), set(), set()
    for key, item in items:
        v = words(item)
        n = min(window, len(v))
        for j in range(len(v) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i:i + n] == v[j:j + n]:
                    hit.update(range(i, i + n))
                    found.add(key)
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [200_000, 12])
def test_benchmark_hits(spark, transcripts, nothing, block_words):
    rows = edge_rows()
    w = words(rows[44][1])
    items = [("a", " ".join(w[5:30])), ("b", " ".join(w[20:50]).upper()), ("c", "gg"), ("d", None), ("e", ""), ("f", " ".join(w[40:44])),
             ("g", " ".join(w[5:30])), ("h", "ab ab ab ab ab ab ab ab ab ab ab"), (None, "the"), ("a", "absent words here")]
    table = spark.createDataFrame(items, "ability_key string, description string")
    got = decontaminate.benchmark_hits(transcripts, table, block_words=block_words) \
        .select("contest_id", "n_words", decontaminate.hit_words().alias("n"), "items").collect()
    exp = Counter((c, *map(str, brute_hits(t, [i for i in items if i[0]], 10))) for c, t in rows)
    assert Counter((r.contest_id, str(r.n_words), str(r.n), str(r["items"])) for r in got) == exp
    assert decontaminate.benchmark_hits(nothing, table).count() == 0
    assert all(r.n_words == len(words(dict(rows)[r.contest_id])) for r in decontaminate.benchmark_hits(transcripts, table.limit(0)).collect()
               if r.contest_id in range(40))


def test_without_benchmark(spark, transcripts):
    w = edge_rows()[44][1].split(" ")
    table = spark.createDataFrame([("a", " ".join(w[5:30]))], "ability_key string, description string")
    out = {r.contest_id: r for r in decontaminate.without_benchmark(transcripts, table).collect()}
    before = dict(edge_rows())
    assert len(out[54].transcript) < len(before[54]) and " ".join(w[5:30]) not in out[54].transcript
    assert out[54].transcript.startswith(" ".join(w[:5])) and out[54]["_text"] == before[54]
    assert all(out[i].transcript == before[i] for i in [*range(40), 50, 51, 52, 58, 62, 64])
    all_of_it = spark.createDataFrame([("a", " ".join(w))], "ability_key string, description string")
    assert 54 not in {r.contest_id for r in decontaminate.without_benchmark(transcripts, all_of_it).collect()}


def test_without_benchmark_in_several_turns(spark, transcripts):
    """More blocks of items than a task holds at once: same rows, by turns."""
    w = edge_rows()[44][1].split(" ")
    table = spark.createDataFrame([(f"k{i}", " ".join(w[a:a + 14])) for i, a in enumerate(range(0, 40, 9))] +
                                  [(f"x{i}", f"other{i} " * 12) for i in range(30)], "ability_key string, description string")
    wider = transcripts.withColumn("_hit_row0", F.lit("clash"))
    once = decontaminate.without_benchmark(wider, table, coverage=0.9)
    turns = decontaminate.without_benchmark(wider, table, coverage=0.9, block_words=80, blocks_at_once=2)
    assert turns.columns == once.columns == wider.columns
    assert Counter(map(str, turns.collect())) == Counter(map(str, once.collect()))
    before = dict(edge_rows())
    assert any(r.transcript != before[r.contest_id] for r in turns.collect())
    assert decontaminate.without_benchmark(wider.limit(0), table, block_words=80, blocks_at_once=2).count() == 0


def test_removed_copies(transcripts, nothing):
    for group in (2000, 2):
        got = longest_previous.remove_copies(transcripts, length=40, group=group).drop("kept").collect()
        seen, exp = set(), Counter()
        for c, t in sorted(((c, t) for c, t in edge_rows()), key=lambda r: low(r[0])):
            data = (t or "").encode()
            gone = np.zeros(len(data), bool)
            for s in range(len(data) - 39):
                if data[s:s + 40] in seen:
                    gone[s:s + 40] = True
                seen.add(data[s:s + 40])
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            exp[c, len(data), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()] += 1
        assert Counter(tuple(r) for r in got) == exp
    assert longest_previous.remove_copies(nothing).count() == 0


def test_removed_sentences(transcripts, nothing):
    got = Counter((r.contest_id, r.n_sentences, r.n_removed, r.kept_sha256) for r in sentence_spans.remove_repeats(transcripts, words=5).collect())
    seen, exp = set(), Counter()
    for c, t in sorted(edge_rows(), key=lambda r: low(r[0])):
        data = (t or "").encode()
        cuts = [0, *(m.end() for m in re.finditer(rb"[.!?](?=[ \t\r\n])|\n", data)), len(data)]
        found = [(a + WORD.search(data[a:b].lower()).start(), WORD.findall(data[a:b].lower())) for a, b in zip(cuts, cuts[1:])
                 if WORD.search(data[a:b].lower())]
        gone = [False] * len(found)
        for k in range(len(found)):
            end, run = k, []
            while end < len(found) and (end - k < 2 or len(run) < 5):
                run += found[end][1]
                end += 1
            if end - k >= 2 and len(run) >= 5:
                if tuple(run) in seen:
                    gone[k:end] = [True] * (end - k)
                seen.add(tuple(run))
        edges = [a for a, _ in found] + [len(data)]
        kept = data[:edges[0]] + b"".join(data[a:b] for a, b, g in zip(edges, edges[1:], gone) if not g)
        exp[c, len(found), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    assert got == exp
    assert sentence_spans.remove_repeats(nothing).count() == 0


def test_removed_sentences_against_all_runs(spark):
    def sentence(name, n, mark=". "):
        return " ".join(f"{name}{i}" for i in range(n)) + mark
    tail = sentence("a", 10) + sentence("b", 3) + sentence("c", 3) + sentence("d", 3)
    alone, marks = sentence("long", 14), sentence("e", 8, ".*** ") + sentence("f", 8, "!%%% ")
    rows = [(1, sentence("p", 4) + tail + alone + marks), (2, sentence("q", 4) + tail + sentence("r", 4)),
            (3, sentence("s", 4) + alone + sentence("t", 4)), (4, sentence("u", 9, "?$$$ ") + marks + sentence("v", 9)), (5, marks * 3)]
    rng = np.random.default_rng(4)
    rows += [(6 + i, "".join(sentence(f"n{k}w", 1 + k * 7 % 16) for k in rng.integers(0, 9, 12))) for i in range(40)]
    source = spark.createDataFrame(rows, "contest_id long, transcript string")
    for least in (2, 3):
        seen, exp = set(), {}
        for c, t in rows:
            found = [WORD.findall(x) for x in re.split(rb"[.!?](?![0-9a-z\x80-\xff])|\n", t.encode()) if WORD.search(x)]
            gone = [False] * len(found)
            for k in range(len(found)):
                for end in range(k + 1, len(found) + 1):
                    run = tuple(w for x in found[k:end] for w in x)
                    if len(run) >= 12 and (end - k >= least or end - k == 1):
                        if run in seen:
                            gone[k:end] = [True] * (end - k)
                        seen.add(run)
            exp[c] = (len(found), sum(gone))
        got = {r.contest_id: (r.n_sentences, r.n_removed) for r in sentence_spans.remove_repeats(source, least=least).collect()}
        assert got == exp
    assert exp[2][1] == 4 and exp[3][1] == 1


def test_near_copies(spark, transcripts, nothing):
    rows = edge_rows()
    source = spark.createDataFrame(rows, "_id long, _text string")
    weights = weighted_minhash.document_frequencies(source)
    vectors = []
    for _, t in rows:
        data = np.frombuffer((t or "").encode(), np.uint8)
        vectors.append(weights.vector(texts.word_hashes(data, np.array([0, len(data)]))[0]))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if weighted_minhash.similarity(vectors[i], vectors[j]) >= 0.8:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    exp = Counter()
    for g in set(group):
        ids = [rows[i][0] for i in range(len(rows)) if group[i] == g]
        exp.update((c, min(ids, key=low), len(ids)) for c in ids)
    got = weighted_minhash.near_copies(transcripts).collect()
    assert Counter((r.contest_id, r.class_id, r.class_size) for r in got) == exp
    assert sum(r.kept for r in got) == len(set(group))
    assert weighted_minhash.near_copies(nothing).count() == 0


def test_near_copies_beyond_the_hubs(spark):
    """Texts near one member of a large circle, but not near its centre, which is in every bucket with them."""
    core = [f"core{i}" for i in range(400)]
    rows = [(0, " ".join(core))]
    for i in range(60):
        own = [f"own{i}n{j}" for j in range(12)]
        rows.append((1 + i, " ".join(own + core[:i] + core[i + 12:])))
        if i % 5 == 0:
            rows.append((100 + i, " ".join(own + [f"far{i}n{j}" for j in range(12)] + core[:i] + core[i + 24:])))
    source = spark.createDataFrame(rows, "contest_id long, transcript string")
    weights = weighted_minhash.document_frequencies(source.withColumnRenamed("transcript", "_text"), 1)
    vectors, sample = [], []
    for _, t in rows:
        data = np.frombuffer(t.encode(), np.uint8)
        vectors.append(weights.vector(texts.word_hashes(data, np.array([0, len(data)]))[0], 1))
        sample.append(weighted_minhash.samples(*vectors[-1], np.array([0, len(vectors[-1][0])]), 1)[0, 0])
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sample[i] == sample[j] and weighted_minhash.similarity(vectors[i], vectors[j]) >= 0.8:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    assert sum(rows[i][0] >= 100 and group[i] == group[0] for i in range(len(rows))) > 6
    got = weighted_minhash.near_copies(source, n=1, bands=1, rows=1, row_col="contest_id").collect()
    assert {r.contest_id: r.class_id for r in got} == {rows[i][0]: min(rows[j][0] for j in range(len(rows)) if group[j] == group[i])
                                                       for i in range(len(rows))}


def test_samples_agree_with_the_similarity():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = (np.sort(h[:240]), rng.uniform(1, 9, 240)), None
    b = np.concatenate([a[0][60:], np.sort(h[240:])]), np.concatenate([a[1][60:], np.full(60, 4.0)])
    got = weighted_minhash.samples(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.array([0, 240, 480]), 2000)
    order = np.argsort(b[0])
    assert abs((got[0] == got[1]).mean() - weighted_minhash.similarity(a, (b[0][order], b[1][order]))) < 0.04


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 9), (5, 5), (3, 7), (7, 20)], "a long, b long")
    got = {r.node: r.component for r in components.components(links, "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 20: 1, 8: 8, 9: 8}


def test_token_files_round_trip(spark, transcripts, nothing, tmp_path):
    plain = Tokenizer.from_file(FILE)
    path = token_files.write_token_files(transcripts, FILE, str(tmp_path / "files"), block_tokens=500)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [low(r.contest_id) for r in got] == sorted(low(c) for c, _ in edge_rows())
    start, exp = 0, Counter()
    for c, t in edge_rows():
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        exp[c, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert Counter((r.contest_id, r.n_tokens, r.ids_crc32) for r in got) == exp
    empty = token_files.write_token_files(nothing, FILE, str(tmp_path / "none"))
    assert token_files.read_token_files(spark, empty).count() == 0


def test_blocks_decode_from_checkpoints_and_show_damage():
    ids = (np.random.default_rng(1).zipf(1.4, 200_000) % 5000).astype(np.uint32)
    table = token_files.FrequencyTable.from_counts(*np.unique(ids, return_counts=True))
    block = token_files.encode_block(ids, table)
    assert (token_files.decode_block(block, table) == ids).all()
    assert (token_files.decode_block(block, table, 1, 2) == ids[65536:131072]).all()
    with pytest.raises(token_files.CorruptBlock):
        token_files.decode_block(block[:200] + bytes([block[200] ^ 1]) + block[201:], table)


def test_packing(transcripts, nothing):
    plain = Tokenizer.from_file(FILE)
    got = packing.pack_transcripts(transcripts, FILE, length=256).collect()
    exp = Counter()
    for c, t in edge_rows():
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for p, s in enumerate(range(0, len(ids), 256)):
            exp[c, p, s, len(ids[s:s + 256]), zlib.crc32(ids[s:s + 256].tobytes())] += 1
    assert Counter((r.contest_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == exp
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
    assert len(held) <= -(-sum(r.length for r in got) // 256) * 1.01 + 1
    assert packing.pack_transcripts(nothing, FILE).count() == 0


def test_packing_plan_is_never_worse_than_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(5):
        histogram = {int(n): int(c) for n, c in zip(rng.integers(1, 300, 30), rng.integers(1, 50, 30))}
        sizes = np.array(sorted(histogram))
        plain = sum(m for _, m in packing._best_fit(np.array([histogram[n] for n in sizes]), sizes, 300))
        assert -(-sum(n * c for n, c in histogram.items()) // 300) <= packing.plan_packing(histogram, 300, 60).sequences <= plain


def test_configurations_cover_every_length():
    rng = np.random.default_rng(5)
    sizes = np.unique(rng.integers(1, 513, 400))
    counts = rng.integers(1, 9, len(sizes))
    assert (sizes > 256).sum() > 120
    cover, bound = packing.configurations(sizes, counts, 512)
    covered = np.zeros(len(sizes))
    for pattern, x in cover:
        assert sum(int(sizes[i]) * c for i, c in pattern.items()) <= 512 and all(c <= counts[i] for i, c in pattern.items())
        for i, c in pattern.items():
            covered[i] += c * x
    assert (covered >= counts * (1 - 1e-9)).all()
    assert (counts * sizes).sum() / 512 <= bound * (1 + 1e-9) and bound <= packing.plan_packing(dict(zip(sizes.tolist(), counts.tolist())), 512).sequences
    assert sum(x for _, x in cover) <= 1.1 * bound


def test_configurations_decide_a_large_histogram():
    lengths, counts = np.unique(np.random.default_rng(1).lognormal(5, 0.9, 200_000).astype(int).clip(1, 512), return_counts=True)
    plan = packing.plan_packing(dict(zip(lengths.tolist(), counts.tolist())), 512)
    assert -(-int((lengths * counts).sum()) // 512) <= plan.sequences < sum(m for _, m in packing._best_fit(counts, lengths, 512))


def test_quality_ranks_held_out_rows(spark, transcripts, nothing):
    good = [(100 + i, " ".join(w for w in f"play{i} ward{i * 7} roam{i * 3} stack{i} pull smoke dive{i} farm").title() + ".", 1) for i in range(30)]
    bad = [(200 + i, "###$$$ " * (i + 3) + "gg " * 40, 0) for i in range(30)]
    frame = spark.createDataFrame([(c, t, 1) for c, t, _ in good + bad], "contest_id long, transcript string, score int")
    labels = spark.createDataFrame([(c, u) for c, _, u in good[:20] + bad[:20]] + [(100, 1), (999, 0), (None, 1)], "contest_id long, usable int")
    model = pairwise_quality.fit_quality(frame, labels)
    got = {r.contest_id: r.score for r in pairwise_quality.score_quality(frame, model).collect()}
    assert all((got[c] >= 0.5) == bool(u) for c, _, u in good + bad)
    scored = pairwise_quality.score_quality(transcripts, model).collect()
    assert len(scored) == len(edge_rows()) and all(0 <= r.score <= 1 for r in scored)
    assert pairwise_quality.usable_only(transcripts, model).columns == transcripts.columns
    assert pairwise_quality.score_quality(nothing, model).count() == 0
    none = pairwise_quality.fit_quality(frame, labels.limit(0))
    assert {r.score for r in pairwise_quality.score_quality(frame, none).collect()} == {0.5}


def test_quality_learns_from_every_labelled_row(spark):
    rows = [(i, ("Ward the pit. " if i % 3 else "### gg gg ") + f"lane{i} " * (i % 5), int(i % 3 > 0)) for i in range(21_000)]
    frame = spark.createDataFrame([(i, t) for i, t, _ in rows], "contest_id long, transcript string")
    labels = spark.createDataFrame([(i, u) for i, _, u in rows], "contest_id long, usable int")
    model = pairwise_quality.fit_quality(frame, labels)
    x = pairwise_quality.text_features(pa.RecordBatch.from_arrays([pa.array([t for _, t, _ in rows])], ["transcript"]), "transcript")
    assert np.allclose(model.mean, x.mean(0), rtol=1e-12) and np.allclose(model.scale, np.where(x.std(0) > 1e-9, x.std(0), 1), rtol=1e-9)
    lead = np.sort(((x - model.mean) / model.scale).clip(-8, 8) @ model.weights)
    assert abs(model.threshold - (lead[6999] + lead[7000]) / 2) < 1e-9
    assert ((model.score(x) >= 0.5) == np.array([u for *_, u in rows], bool)).all()


def test_probabilities_sum_to_one_and_learning_helps():
    net = pseudo_likelihood.WindowNetwork()
    rng = np.random.default_rng(0)
    own = np.cumsum(rng.integers(0, 2, 4000)) % 40 * 20
    bounds = np.array([0, 1500, 1500, 4000])
    sides = net.sides(own, bounds)
    assert (sides[:2, 0] == pseudo_likelihood.TOKENS).all() and (sides[2:, 1499] == pseudo_likelihood.TOKENS).all()
    one = np.repeat(sides[:, 7:8], pseudo_likelihood.TOKENS, 1)
    assert abs(np.exp(net.log_probability(np.arange(pseudo_likelihood.TOKENS), one)).sum() - 1) < 1e-3
    before = net.log_probability(own, sides).mean()
    squares = np.full(len(net.flat), 1e-4, np.float32)
    for _ in range(30):
        net.learn(own, sides, squares)
    assert net.log_probability(own, sides).mean() > before + 1


def test_pseudo_likelihood(transcripts, nothing):
    got = pseudo_likelihood.pseudo_likelihood(transcripts).collect()
    assert Counter((r.contest_id, r.n_words) for r in got) == Counter((c, len(words(t))) for c, t in edge_rows())
    assert all((r.perplexity is None) == (r.n_words == 0) and r.log_likelihood <= 0 for r in got)
    assert pseudo_likelihood.pseudo_likelihood(nothing).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>no</title><script>var a="</p>";</script></head><body><nav><ul><li>Home<li>Teams</ul></nav>
<div class="ad">Buy</div>{body}<aside>side</aside><div id=comments><p>first!</p></div><footer>&copy; x</footer></body></html>"""


def test_main_text(spark):
    chrome = "<p>Sign in to follow every match of your team now</p>"
    rows = [(i, "http://a.example/x", PAGE.format(body=f"{chrome}<p>u{i}a u{i}b&nbsp;u{i}c   u{i}d &amp; u{i}e<br>line {i}</p>"), "x") for i in range(5)]
    rows += [(10, "https://b.example/", PAGE.format(body="<article><h1>Head</h1><p>Same <b>bo</b>dy.</p></article>"), "x"),
             (11, "https://b.example/2", PAGE.format(body="<article><h1>Head</h1><p>Same <b>bo</b>dy.</p></article>"), "x"),
             (12, None, None, "x"), (12, None, "", "x"), (None, "junk", "a < b <p title=\"x\">c", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, _host string")
    got = html_runs.extract_main_text(pages).collect()
    found = Counter((r.page_id, r.text) for r in got)
    assert found == Counter([(i, f"u{i}a u{i}b u{i}c u{i}d & u{i}e line {i}") for i in range(5)] + [(10, "Head Same body."), (11, "Head Same body."),
                            (12, ""), (12, ""), (None, "a < b c")])
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_runs.extract_main_text(pages.limit(0)).count() == 0


def test_main_text_counts_runs_over_whole_hosts(spark):
    """Runs on three pages of a host are boilerplate however far apart the pages stand, and only on that host."""
    rng = random.Random(5)
    notes = [" ".join(f"n{k}é{i}" for i in range(8)) for k in range(40)]
    bodies = []
    for i in range(150):
        parts = [f"<p>own{i} text{i}</p>"] + [f"<p>{notes[k]}</p>" for k in range(40) if (i % 50 == k or i in (1, 149) and k % 3)]
        parts += [f"<article><p>{notes[i % 40]} art</p></article>"] if i % 7 == 0 else []
        rng.shuffle(parts)
        bodies.append("".join(parts))
    rows = [(i, "http://a.example/x", PAGE.format(body=b)) for i, b in enumerate(bodies)]
    rows += [(1000 + i, "http://b.example/x", PAGE.format(body=bodies[i])) for i in (0, 50)]
    rows += [(2000, "http://c.example/", "<article>all said</article>"), (2001, "http://a.example/", None)]
    got = html_runs.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
    whole = html_runs.main_texts([h for _, u, h in rows if u and "a.example" in u])
    expected = dict(zip([i for i, u, _ in rows if "a.example" in u], whole)) | {2000: "all said"}
    expected |= dict(zip([1000, 1050], html_runs.main_texts([h for _, u, h in rows if "b.example" in u])))
    assert {r.page_id: r.text for r in got} == expected and len(got) == len(rows)
    assert "n5é" not in expected[55] and "n0é" in expected[1000]


def test_main_text_counts_the_runs_of_pages_that_markup_decides(spark, monkeypatch):
    """Runs of every page are counted, also where the markup leaves no block open; packed hashes come back as they were."""
    rng = np.random.default_rng(6)
    note = " ".join(f"w{i}" for i in range(30))
    htmls = [f"<nav>{note}</nav><article><p>own{i} {note if i % 2 else 'short'}</p></article>" for i in range(70)]
    rows = [(i, f"http://{'ab'[i % 7 == 0]}.example/{i}", h) for i, h in enumerate(htmls)]
    written = {}
    plain = html_runs.scratch_table
    monkeypatch.setattr(html_runs, "scratch_table", lambda df, name: written.setdefault(name, plain(df, name)))
    got = html_runs.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    assert {r.page_id: r.text for r in got} == {i: f"own{i} {note if i % 2 else 'short'}" for i in range(70)}
    hosts = {h: spark.range(1).select(F.xxhash64(F.lit(h))).first()[0] for h in ("a.example", "b.example")}
    counts = Counter(x for i, u, h in rows for x in set(html_runs.page_runs(html_runs.blocks(h), hosts[u[7:16]]).tolist()))
    expected = {x for x, n in counts.items() if n >= 3}
    found = [r["_run"] for r in written["frequent-runs"].collect()]
    assert len(expected) >= 50 and set(found) == expected and len(found) == len(expected)
    for n in (0, 1, 63, 64, 65, 5000):
        runs = np.sort(rng.integers(0, 1 << 64, n, np.uint64))
        assert np.array_equal(html_runs.unpacked_runs(html_runs.packed_runs(runs), n), runs)


def test_repeated_tokens_against_brute_force():
    rng = np.random.default_rng(4)
    streams = [[str(x) for x in rng.integers(0, 3, rng.integers(0, 40))] for _ in range(6)]
    for got, stream in zip(html_runs.repeated_tokens(streams, 4, 3), streams):
        exp = np.zeros(len(stream), bool)
        for i in range(len(stream) - 3):
            holds = sum(any(s[j:j + 4] == stream[i:i + 4] for j in range(len(s) - 3)) for s in streams)
            if holds >= 3:
                exp[i:i + 4] = True
        assert (got == exp).all()


ARTICLE_TEXT = "<p>" + " ".join(f"w{i}" for i in range(50)) + "</p>"


@pytest.mark.parametrize("page, kept", [
    (f'<div class="content has-sidebar">{ARTICLE_TEXT}</div>', 1),
    (f'<div class="post social-post">{ARTICLE_TEXT}<div class="site-comments"><p>nice one</p></div></div>', 1),
    (f'<nav>Home</nav><div id="main-nav-wrapper">{ARTICLE_TEXT}</div><div class="page-footer">About</div>', 1),
    (f'<article>{ARTICLE_TEXT}</article><div class="reader-comments">{ARTICLE_TEXT * 9}</div>', 1),
    (f'<div class="ad">{ARTICLE_TEXT}</div>', 0),
    (f"<a title=it's></a>{ARTICLE_TEXT}<div class='x sidebar'>it's</div>", 1)])
def test_names_that_only_sound_like_chrome(page, kept):
    assert html_runs.main_texts([page]) == [ARTICLE_TEXT[3:-4] * kept]


@pytest.mark.parametrize("part", ["<div '", "<a b='>'", '<a b="', "<!-- ", "<![CDATA[ ", "<div class=x-ad>", "<b =", "</script   "])
def test_long_malformed_pages_take_linear_time(part):
    started = time.process_time()
    html_runs.blocks(part * (1_000_000 // len(part)))
    html_runs.blocks("<div>" * 100_000 + "</p>" * 100_000)
    assert time.process_time() - started < 20
