"""Main text of web pages: markup zones, and runs of tokens that several pages of a host repeat.

The reference data holds no web pages, so this operator is general: it takes any (page_id, url, html).
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.llm.texts import BASE, mix, pinned, prefix_sums, scratch_table, shingle_hashes, span_hashes
from draftlake.operators.joins import salted_lookup
from draftlake.sources.tables import spread

RUN, PAGES, LONGEST = 6, 3, 80

# Runs are dealt by their first bits; fewer than FEW hashes travel unpacked; what a task holds beside the hashes.
BUCKET_BITS, FEW = 12, 64
PAGES_AT_ONCE, PACKED_AT_ONCE = 256, 1 << 18
BUCKETS = 1 << BUCKET_BITS

# Elements and names that mark what is not the article.
RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "canvas", "math", "title"}
CHROME = {"head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "header"}
MAIN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr", "img"}
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "sidebar", "cookie", "cookies", "consent", "notice", "notices",
         "newsletter", "subscribe", "subscription", "promo", "promotion", "sponsor", "sponsored", "share", "sharing", "social",
         "related", "breadcrumb", "breadcrumbs", "menu", "nav", "navbar", "navigation", "footer", "comment", "comments", "reply",
         "replies", "popup", "modal", "widget", "masthead", "toolbar", "pagination", "pager", "skip"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}

_START = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTES = re.compile(r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+")
_NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_PART = re.compile(r"[a-z]+")
ARTICLE, PLAIN, OUTSIDE = 2, 1, 0
FAINT, SURE = 1, 2
OUTWEIGHED = 4


def _marked(attributes: str) -> int:
    """SURE where hidden, role or a whole class or id names something beside the article, FAINT where part of one does, else 0."""
    found = 0
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            return SURE
        if name in ("class", "id"):
            if not NAMES.isdisjoint(value.split()):
                return SURE
            if not NAMES.isdisjoint(_PART.findall(value)):
                found = FAINT
    return found


def _tags(page: str):
    """(text before, closing, tag, attributes) of each tag of a page, then the text after the last with tag None.

    Comments and declarations are left out, CDATA is text. A quote counts after an equals sign only. Where the attributes
    of a tag do not end before the page does, that tag and all later ones end at the next ``>``, so no text is read over and over.
    """
    at, end, quoted, absent = 0, len(page), True, set()
    pieces: list[str] = []

    def find(mark: str, start: int) -> int:
        place = -1 if mark in absent else page.find(mark, start)
        if place < 0:
            absent.add(mark)
        return place

    while m := _START.search(page, at):
        pieces.append(page[at:m.start()])
        at = m.end()
        if m.group() == "<!--":
            close = find("-->", at)
            at = close + 3 if close >= 0 else end
            continue
        if m.group() == "<![CDATA[" and (close := find("]]>", at)) >= 0:
            pieces.append(page[at:close].replace("&", "&amp;"))
            at = close + 3
            continue
        close = _ATTRIBUTES.match(page, at).end() if quoted and m.group(2) else find(">", at)
        if close == end:
            quoted, close = False, find(">", at)
        if close < 0:
            at = m.start()
            break
        if not m.group(2):
            at = close + 1
            continue
        tag, attributes = m.group(2).lower(), page[at:close]
        at = close + 1
        yield "".join(pieces), bool(m.group(1)), tag, attributes
        pieces.clear()
        if tag in RAW and not m.group(1) and not attributes.rstrip().endswith("/"):
            over = _RAW_END[tag].search(page, at)
            at = over.end() if over else end
    yield "".join([*pieces, page[at:]]), False, None, ""


_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}


def blocks(page: str) -> list[tuple[str, int]]:
    """(text, zone) of the blocks of a page in order: ARTICLE inside article or main, OUTSIDE in chrome, else PLAIN.

    Character references are decoded, white space inside a block is one space, empty blocks are left out. Unclosed and
    stray tags are taken as they come; an end tag closes everything opened since its start tag. An element that is marked
    FAINT is chrome unless the text that is left without it lies in no article and is less than a quarter of its own:
    a page's text often stands in a "has-sidebar" or a "nav-wrapper".
    """
    out: list[tuple[str, int, int]] = []
    open_tags: list[tuple[str, int, bool]] = []
    number: Counter = Counter()
    faint: list[int] = []
    parents: list[int] = []
    chrome = main = 0
    pieces: list[str] = []

    def end_block():
        text = " ".join(entities.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            out.append((text, OUTSIDE if chrome else ARTICLE if main else PLAIN, faint[-1] if faint else -1))

    for before, closing, tag, attributes in _tags(page):
        pieces.append(before)
        if tag is None:
            break
        if tag not in INLINE:
            end_block()
        if tag in RAW:
            continue
        if closing:
            if not number[tag]:
                continue
            i = len(open_tags) - 1
            while open_tags[i][0] != tag:
                i -= 1
            if any(c or a for _, c, a in open_tags[i:]):
                end_block()
            for name, c, a in open_tags[i:]:
                number[name] -= 1
                chrome -= c == SURE
                main -= a
                if c == FAINT:
                    faint.pop()
            del open_tags[i:]
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            aside = SURE if tag in CHROME and not (tag == "header" and main) else \
                0 if tag in ("html", "body", *MAIN) else _marked(attributes)
            if aside:
                end_block()
            if aside == FAINT:
                parents.append(faint[-1] if faint else -1)
                faint.append(len(parents) - 1)
            open_tags.append((tag, aside, tag in MAIN))
            number[tag] += 1
            chrome += aside == SURE
            main += tag in MAIN
    end_block()
    stays = _outweighing(out, parents)
    return [(text, zone if of in stays else OUTSIDE) for text, zone, of in out]


def _outweighing(found: list[tuple[str, int, int]], parents: list[int]) -> set[int]:
    """The FAINT elements that stay, and -1 for text in none.

    The heaviest stays where the text left without it is less than a quarter of its own and no article; then those in it are
    judged in the same way.
    """
    own, total, inner = Counter(), Counter(), {}
    for text, zone, of in found:
        if zone != OUTSIDE:
            own[of] += len(text)
    for i in range(len(parents) - 1, -1, -1):
        total[i] += own[i]
        if parents[i] >= 0:
            total[parents[i]] += total[i]
        inner.setdefault(parents[i], []).append(i)
    stays, left, last = {-1}, own[-1], -1
    articles = {of for _, zone, of in found if zone == ARTICLE}
    while last not in articles and (heavy := max(inner.get(last, []), key=lambda i: (total[i], -i), default=None)) is not None \
            and left * OUTWEIGHED < total[heavy]:
        stays.add(heavy)
        left, last = left + own[heavy], heavy
    return stays


def repeated_tokens(streams: list[list[str]], run: int = RUN, pages: int = PAGES) -> list[np.ndarray]:
    """For each token stream, which tokens lie in a run of ``run`` or more tokens that ``pages`` distinct pages hold.

    The streams are concatenated with a separator of its own after each; the suffixes are sorted to a depth of ``run``
    tokens by doubling, so equal runs stand together. Overlapping runs join, whatever their length.
    """
    sizes = np.array([len(s) for s in streams])
    numbers: dict[str, int] = {}
    flat = [numbers.setdefault(t, len(numbers)) for s in streams for t in s]
    page = np.repeat(np.arange(len(streams)), sizes)
    text = np.full(len(flat) + len(streams), -1, np.int64)
    place = np.arange(len(flat)) + page
    text[place] = flat
    text[text < 0] = len(numbers) + np.arange(len(streams))
    rank, known, n = text, 1, len(text)
    while known < run:
        shift = min(known, run - known)
        after = np.zeros(n, np.int64)
        after[:max(0, n - shift)] = rank[shift:] + 1
        _, rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + after, return_inverse=True)
        known += shift
    rank = rank[place]
    order = np.lexsort((page, rank))
    r, p = rank[order], page[order]
    new_rank = np.diff(r, prepend=-1) != 0
    distinct = np.add.reduceat((new_rank | (np.diff(p, prepend=-1) != 0)).astype(int), np.flatnonzero(new_rank)) if len(r) else r
    often = np.zeros(len(flat), bool)
    often[order] = (distinct >= pages)[np.cumsum(new_rank) - 1] if len(r) else False
    return [_covered(often[a:b], b - a, run) for a, b in zip(np.cumsum(sizes) - sizes, np.cumsum(sizes))]


def _covered(often: np.ndarray, size: int, run: int) -> np.ndarray:
    """Which of ``size`` tokens lie in a run that starts where ``often`` says."""
    change = np.zeros(size + run + 1, np.int64)
    begin = np.flatnonzero(often)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + run, -1)
    return np.cumsum(change)[:size] > 0


def page_runs(page: list[tuple[str, int]], host: int, run: int = RUN) -> np.ndarray:
    """A hash of the host and the ``run`` tokens from each place of a page's blocks on, in order; none for a shorter page."""
    data = np.frombuffer(" ".join(text for text, _ in page).encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    gaps = np.flatnonzero(data == 32)
    tokens = span_hashes(prefix_sums(data), np.append(0, gaps + 1), np.append(gaps, len(data)))
    return mix(shingle_hashes(tokens, run) ^ mix(np.array([host], np.int64).view(np.uint64) * BASE)).view(np.int64)


def _text(page: list[tuple[str, int]], hit: np.ndarray, longest: int) -> str:
    """The blocks of a page without chrome, and without the covered tokens of blocks outside an article."""
    edges = np.flatnonzero(np.diff(hit, prepend=False, append=False))
    boilerplate = np.zeros(len(hit), bool)
    for a, b in zip(edges[::2], edges[1::2]):
        boilerplate[a:b] = b - a <= longest
    kept, at = [], 0
    for text, zone in page:
        tokens = text.split()
        own = boilerplate[at:at + len(tokens)]
        at += len(tokens)
        if zone == ARTICLE:
            kept.append(text)
        elif zone == PLAIN:
            kept.extend(t for t, gone in zip(tokens, own) if not gone)
    return " ".join(kept)


def main_texts(pages: list[str], run: int = RUN, least: int = PAGES, longest: int = LONGEST) -> list[str]:
    """The main text of pages of one host that are held together, by a suffix order over their tokens.

    Runs that several pages repeat are boilerplate where the markup does not say article; runs of more than ``longest``
    tokens are copies of an article and stay. What the markup says is chrome goes whether it repeats or not.
    """
    parsed = [blocks(p or "") for p in pages]
    covered = repeated_tokens([[t for text, _ in page for t in text.split()] for page in parsed], run, least)
    return [_text(page, hit, longest) for page, hit in zip(parsed, covered)]


def _batch(batch: pa.RecordBatch, texts: list, more: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns[:3], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), *more],
        ["_row", "_id", "_url", "text", "n_chars", *names])


def packed_runs(runs: np.ndarray) -> bytes:
    """Sorted hashes as bytes: of few as they are, else the gaps between them, byte by byte in planes and compressed."""
    if len(runs) < FEW:
        return runs.tobytes()
    gaps = np.diff(runs, prepend=np.uint64(0))
    return pa.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpacked_runs(data: bytes, n: int) -> np.ndarray:
    """The ``n`` hashes that ``packed_runs`` turned to bytes."""
    if n < FEW:
        return np.frombuffer(data, np.uint64)
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64)[:, 0], dtype=np.uint64)


def _at_most(runs: np.ndarray, least: int) -> np.ndarray:
    """Sorted hashes with at most ``least`` copies of each."""
    return runs[np.append(np.ones(min(least, len(runs)), bool), runs[least:] != runs[:-least])] if len(runs) else runs


def frequent_runs(source: DataFrame, run: int = RUN, least: int = PAGES) -> DataFrame:
    """(_run) of every run of tokens that ``least`` pages of a host hold, from (_html, _host) of all pages.

    The runs of the pages of a batch are sorted and dealt by their first bits; a piece travels as one row of packed hashes,
    and the pieces of a bucket meet in one task, a bucket after the other. A host's pages need not stand together. There is
    a null as well where some page has a block that its markup leaves open.
    """
    def pieces(batches):
        for batch in batches:
            own, ask = [np.zeros(0, np.uint64)], False
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                for html, of in zip(*(c.to_pylist() for c in batch.slice(at, PAGES_AT_ONCE).columns)):
                    page = blocks(html or "")
                    ask = ask or any(zone == PLAIN for _, zone in page)
                    own.append(np.unique(page_runs(page, of, run).view(np.uint64)))
            runs = np.concatenate(own)
            own.clear()
            runs.sort()
            runs = _at_most(runs, least)
            bounds = np.append(np.searchsorted(runs, np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)), len(runs))
            filled = np.flatnonzero(np.diff(bounds))
            for some in np.array_split(filled, max(1, len(runs) // PACKED_AT_ONCE)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int32()), pa.array(np.diff(bounds)[some], pa.int64()),
                     pa.array([packed_runs(runs[bounds[i]:bounds[i + 1]]) for i in some], pa.binary())], ["_bucket", "_n", "_packed"])
            if ask:
                yield pa.RecordBatch.from_arrays([pa.array([BUCKETS], pa.int32()), pa.array([0], pa.int64()), pa.array([b""])], ["_bucket", "_n", "_packed"])

    def met(batches):
        held, last = [], None

        def often():
            if last == BUCKETS:
                return pa.RecordBatch.from_arrays([pa.array([None], pa.int64())], ["_run"])
            runs = np.concatenate(held)
            runs.sort()
            found = np.unique(runs[least - 1:][runs[least - 1:] == runs[:len(runs) - least + 1]])
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["_run"])
        for batch in batches:
            for bucket, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                if held and bucket != last:
                    yield often()
                    held = []
                last = bucket
                held.append(unpacked_runs(data, n))
        if held:
            yield often()

    dealt = spread(source.select("_html", "_host").mapInArrow(pieces, "_bucket int, _n long, _packed binary"), "_bucket")
    return dealt.sortWithinPartitions("_bucket").mapInArrow(met, "_run long")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      run: int = RUN, least: int = PAGES, longest: int = LONGEST) -> DataFrame:
    """(id, url, text, n_chars) of every page; text is empty where there is none. It is that of ``main_texts`` over all
    pages of the page's host.

    The runs of all pages are counted by host, and those that ``least`` pages hold are written down. They are brought to the
    pages with blocks that their markup leaves open; in all other blocks what repeats changes nothing. No task holds a host,
    and a run on many pages is split by page. Null html counts as empty, null urls are one host, repeated rows are pages of
    their own; other columns are not read. n_chars counts code points.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    host = F.coalesce(F.lower(F.regexp_extract(url_col, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    source = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html"),
                          F.xxhash64(host).alias("_host"))
    found = f"_row long, _id {kind}, _url string, text string, n_chars long"

    def parsed(batches):
        for batch in batches:
            texts, asking = [], []
            for html in batch.column(3).to_pylist():
                page = blocks(html or "")
                ask = any(zone == PLAIN for _, zone in page)
                texts.append("" if ask else " ".join(text for text, zone in page if zone == ARTICLE))
                asking.append(html if ask else None)
            yield _batch(batch, texts, [batch.column(4), pa.array(asking, pa.string())], ["_host", "_html"])

    def asked(batches):
        for batch in batches:
            for row, html, of in zip(*(c.to_pylist() for c in batch.columns)):
                runs = np.unique(page_runs(blocks(html), of, run))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(runs), row, np.int64)), pa.array(runs)], ["_row", "_run"])

    def settled(batches):
        for batch in batches:
            texts = []
            for html, of, often in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5))):
                page = blocks(html)
                hit = np.isin(page_runs(page, of, run), np.array(often or [], np.int64))
                texts.append(_text(page, _covered(hit, sum(len(text.split()) for text, _ in page), run), longest))
            yield _batch(batch, texts, [], [])

    fixed = pinned(source)
    often = scratch_table(frequent_runs(fixed, run, least), "frequent-runs")
    first = fixed.select(F.monotonically_increasing_id().alias("_row"), "*").mapInArrow(parsed, f"{found}, _host long, _html string")
    done = first.where("_html is null")
    if not often.where("_run is null").isEmpty():
        asking = scratch_table(first.where("_html is not null"), "asking-pages")
        own = scratch_table(asking.select("_row", "_html", "_host").mapInArrow(asked, "_row long, _run long"), "asked-runs")
        known = often.where("_run is not null").select("_run", F.lit(True).alias("_often"))
        per_page = salted_lookup(own, known, "_run", "_row").where("_often").groupBy("_row").agg(F.collect_list("_run").alias("_runs"))
        last = asking.join(per_page, "_row", "left").select("_row", "_id", "_url", "_html", "_host", "_runs").mapInArrow(settled, found)
        done = done.select(last.columns).union(last)
    return done.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars")
