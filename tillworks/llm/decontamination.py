"""Benchmark decontamination: passages of benchmark items in documents, also when edited."""

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import mix, powers, ranges, slices
from tillworks.llm.storage import stored

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
_SIEVE = 1 << 22
_SLOTS = 20
_NOTHING = np.uint32(0xFFFFFFFF)
#: Candidates that are aligned together, cells of their matrices, and shared places per block.
_ALIGNED = 4096
_CELLS = 1 << 20
_BLOCK = 1 << 21
_BEYOND = np.int16(1 << 14)
_MATCHES = "doc_id bigint, item_id bigint, start bigint, end bigint, edits int, passage string"


def normalised(texts):
    """Code points of all texts, lower-cased and with runs of white space as one space; the text
    that each is from, and its place there."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), lengths)
    place = ranges(lengths)
    if not len(codes):
        return codes, owner, place
    used = np.flatnonzero(np.bincount(codes))
    lower = np.arange(int(used[-1]) + 1, dtype=np.uint32)
    space = np.zeros(len(lower), dtype=bool)
    for code in used:
        c = chr(code)
        space[code] = c.isspace()
        lower[code] = ord(c.lower()) if len(c.lower()) == 1 else code
    gap = space[codes]
    keep = ~gap
    keep[1:] |= ~gap[:-1] & (owner[1:] == owner[:-1])
    return np.where(gap, np.uint32(32), lower[codes])[keep], owner[keep], place[keep]


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of every run of q code points."""
    n = len(codes) - q + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(q):
        h *= _FACTOR
        h += codes[i : i + n]
    return mix(h)


def _joins_words(codes: np.ndarray) -> np.ndarray:
    """Whether each code point is part of a word that spaces or marks end; signs of scripts
    that are written without spaces are not."""
    if not len(codes):
        return np.zeros(0, dtype=bool)
    used = np.flatnonzero(np.bincount(codes))
    joins = np.zeros(int(used[-1]) + 1, dtype=bool)
    for code in used:
        unspaced = 0x0E00 <= code < 0x1000 or 0x2E80 <= code < 0xA000 or code >= 0x20000
        joins[code] = chr(code).isalnum() and not unspaced
    return joins[codes]


def _prefix_sums(codes: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(len(codes), _FACTOR), out=sums[1:])
    return sums


@dataclass
class Patterns:
    """Runs of code points to find, with their edits and the q-grams that each must share."""

    owners: np.ndarray  # place of each one's item
    places: np.ndarray  # in that item
    texts: list
    edits: np.ndarray
    shared: np.ndarray
    starts: np.ndarray  # of the postings of each key
    items: np.ndarray
    offsets: np.ndarray


@dataclass
class Index:
    """The q-grams of a bounded set of items: of the whole items, and of windows of them."""

    q: int
    window: int
    ids: np.ndarray
    texts: list  # code points per item
    keys: np.ndarray  # distinct q-grams, sorted
    whole: Patterns
    windows: Patterns | None
    short_ids: dict  # by length: the ids of items under the floor
    short_texts: dict
    short_hashes: dict


def _patterns(owners, places, texts, q, rate, keys) -> Patterns:
    sizes = np.array([len(c) for c in texts], dtype=np.int64)
    edits = np.minimum((sizes * rate).astype(np.int64), (sizes - q) // q)
    hashes = [grams(c, q) for c in texts]
    counts = np.array([len(h) for h in hashes], dtype=np.int64)
    item, offset = np.repeat(np.arange(len(texts)), counts), ranges(counts)
    flat = np.searchsorted(keys, np.concatenate([np.zeros(0, dtype=np.uint64), *hashes]))
    order = np.argsort(flat, kind="stable")
    return Patterns(
        np.array(owners, dtype=np.int64), np.array(places, dtype=np.int64), texts, edits,
        sizes - q + 1 - edits * q, np.searchsorted(flat[order], np.arange(len(keys) + 1)),
        item[order], offset[order],
    )


def build_index(ids, texts, q: int, rate: float, min_chars: int, window: int | None = None) -> Index:
    """Index items; those under ``min_chars`` normalised characters for exact matches only.

    An item or window of m characters may have ``rate * m`` edits, fewer if otherwise it need share
    no q-gram: an occurrence with k edits shares m - q + 1 - kq of them (the q-gram lemma). Windows
    begin at every third of their length, and one ends where the item ends.
    """
    names, codes, short = [], [], {}
    for name, text in zip(ids, texts):
        code = normalised([text.strip()])[0]
        if len(code) >= max(min_chars, q):
            names.append(name)
            codes.append(code)
        elif len(code):
            short.setdefault(len(code), []).append((name, code))
    keys = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *[grams(c, q) for c in codes]]))
    whole = _patterns(np.arange(len(codes)), np.zeros(len(codes)), codes, q, rate, keys)
    windows = None
    if window:
        at = [
            (i, p)
            for i, c in enumerate(codes)
            if len(c) > window
            for p in sorted({*range(0, len(c) - window, max(window // 3, 1)), len(c) - window})
        ]
        parts = [codes[i][p : p + window] for i, p in at]
        if parts:
            windows = _patterns([i for i, _ in at], [p for _, p in at], parts, q, rate, keys)
    short_ids, short_texts, short_hashes = {}, {}, {}
    for length, found in short.items():
        hashes = np.array([_prefix_sums(c)[-1] for _, c in found], dtype=np.uint64)
        order = np.argsort(hashes, kind="stable")
        short_ids[length] = [found[i][0] for i in order]
        short_texts[length] = [found[i][1] for i in order]
        short_hashes[length] = hashes[order]
    return Index(
        q, window or 0, np.array(names, dtype=np.int64), codes, keys, whole, windows,
        short_ids, short_texts, short_hashes,
    )


def _hits(codes, owner, index):
    """Places of q-grams that items have too, and which they are."""
    hashes = grams(codes, index.q)
    sieve = np.zeros(_SIEVE, dtype=bool)
    low = np.uint64(_SIEVE - 1)
    sieve[index.keys & low] = True
    at = np.flatnonzero(sieve[hashes & low] & (owner[: len(hashes)] == owner[index.q - 1 :]))
    place = np.searchsorted(index.keys, hashes[at])
    place = np.minimum(place, len(index.keys) - 1)
    hit = index.keys[place] == hashes[at]
    return at[hit], place[hit]


def _blocks(sizes):
    """Stretches of a list of sizes that add up to about ``_BLOCK`` each, one size at least."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + _BLOCK, side="right")))
        yield slice(start, stop)
        start = stop


def _candidates(codes, owner, at, place, patterns):
    """Diagonal bands with as many shared q-grams as an occurrence must have.

    A band of a pattern with k edits spans 2(k + 1) diagonals and overlaps the next by half, so the
    k + 1 diagonals of an occurrence lie in one. A q-gram that occurs often in a text and in the
    patterns makes very many shared places, so places are counted in blocks: first all of them in
    slots, then those of bands whose slot has enough.
    """
    rows = int(owner[-1]) + 1 if len(owner) else 1
    width = 2 * len(codes) + 4
    counts = patterns.starts[place + 1] - patterns.starts[place]

    def keys(block):
        """Both bands of each shared place, their slots, and the q-grams that they must share."""
        n = counts[block]
        posting = np.repeat(patterns.starts[place[block]], n) + ranges(n)
        item, where = patterns.items[posting], np.repeat(at[block], n)
        diagonal = where - patterns.offsets[posting] + int(len(codes) + 1)  # positive
        band = diagonal // (patterns.edits[item] + 1)
        key = (item * width + band) * rows + owner[where]
        key = np.concatenate((key, key - rows))
        slot = ((key.astype(np.uint64) * _FACTOR) >> np.uint64(64 - _SLOTS)).astype(np.int64)
        return key, slot, np.tile(patterns.shared[item], 2)

    # Bands that share a slot are counted as one, so none with enough is left out here.
    slots, blocks = np.zeros(1 << _SLOTS, dtype=np.int64), list(_blocks(counts))
    first = None
    for block in blocks:
        first = keys(block)
        slots += np.bincount(first[1], minlength=1 << _SLOTS)
    found, shared = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for block in blocks:
        key, slot, least = first if len(blocks) == 1 else keys(block)
        some, times = np.unique(key[slots[slot] >= least], return_counts=True)
        found, of = np.unique(np.concatenate((found, some)), return_inverse=True)
        shared = np.bincount(of, weights=np.concatenate((shared, times)), minlength=len(found)).astype(np.int64)
    item = found // rows // width
    enough = shared >= patterns.shared[item]
    key, item = found[enough], item[enough]
    band, row = key // rows % width, key % rows
    first = band * (patterns.edits[item] + 1) - int(len(codes) + 1)
    return item, row, first


def _band_fits(codes, starts, item, row, first, patterns):
    """Which candidates align within their edits, on the diagonals of their band alone.

    All candidates of a chunk go through their patterns together, one character at a time; one
    whose cells all exceed its edits is dropped on the way. Chunks hold patterns of about one
    length; cells beyond a candidate's own band do not count.
    """
    sizes = np.array([len(t) for t in patterns.texts], dtype=np.int64)
    fits = np.zeros(len(item), dtype=bool)
    order = np.argsort(sizes[item], kind="stable")
    for c in range(0, len(order), _ALIGNED):
        left = order[c : c + _ALIGNED]
        size, edits = sizes[item[left]], patterns.edits[item[left]]
        used, which = np.unique(item[left], return_inverse=True)
        padded = np.full((len(used), int(size.max())), _NOTHING, dtype=np.uint32)
        for k, i in enumerate(used):
            padded[k, : sizes[i]] = patterns.texts[i]
        diagonals = np.arange(2 * (int(edits.max()) + 1))
        at = first[left][:, None] + diagonals[None, :]
        low, high = starts[row[left]][:, None], starts[row[left] + 1][:, None]
        steps = diagonals.astype(np.int16)
        beyond = diagonals[None, :] >= 2 * (edits[:, None] + 1)
        cost = np.where(beyond, _BEYOND, np.int16(0))
        for i in range(padded.shape[1]):
            text = np.where((at >= low) & (at < high), codes[np.clip(at, 0, len(codes) - 1)], _NOTHING - np.uint32(1))
            new = cost + (text != padded[which, i][:, None])
            np.minimum(new[:, :-1], cost[:, 1:] + 1, out=new[:, :-1])  # a character of the pattern is missing
            cost = np.minimum.accumulate(new - steps, axis=1) + steps  # or the text has one more
            cost[beyond] = _BEYOND
            at += 1
            ended = size == i + 1
            best = cost.min(axis=1) if i % 8 == 7 or ended.any() else None
            if best is not None:
                fits[left[ended & (best <= edits)]] = True
                on = ~ended & (best <= edits)
                if not on.all():
                    left, which, size, edits, cost, at, beyond = (
                        x[on] for x in (left, which, size, edits, cost, at, beyond)
                    )
                    low, high = low[on], high[on]
                    if not len(left):
                        break
    return fits


def _padded(texts):
    """Runs of code points as the rows of one array, and their sizes."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    rows = np.full((len(texts), int(sizes.max(initial=0))), _NOTHING, dtype=np.uint32)
    for k, text in enumerate(texts):
        rows[k, : len(text)] = text
    return rows, sizes


def _aligned(codes, starts, candidates, patterns):
    """Candidates that align within their edits, as an array of text, pattern, first place, place
    behind and edits: of the stretches near the band the one with the fewest edits."""
    item, row, first = candidates
    fits = _band_fits(codes, starts, item, row, first, patterns)
    item, row, first = item[fits], row[fits], first[fits]
    sizes = np.array([len(t) for t in patterns.texts], dtype=np.int64)
    order, out = np.argsort(sizes[item], kind="stable"), []
    widest = int((sizes + 4 * patterns.edits).max(initial=0)) + 2
    for c in range(0, len(order), max(1, _CELLS // widest)):
        of = order[c : c + max(1, _CELLS // widest)]
        pattern, size = _padded([patterns.texts[i] for i in item[of]])
        edits, low, high = patterns.edits[item[of]], starts[row[of]], starts[row[of] + 1]

        def stretch(at, inside, low=low, high=high):
            inside = inside & (at >= low[:, None]) & (at < high[:, None])
            return np.where(inside, codes[np.clip(at, 0, len(codes) - 1)], _NOTHING - np.uint32(1))

        columns = np.arange(int((size + 4 * edits).max()) + 2)[None, :]
        begin = first[of] - edits
        last = _last_rows(pattern, size, stretch(begin[:, None] + columns, columns < (size + 4 * edits + 2)[:, None]), False)
        ends, least = begin + last.argmin(axis=1), last.min(axis=1)
        near = np.flatnonzero(least <= edits)
        if not len(near):
            continue
        low, high, ends, size, edits = low[near], high[near], ends[near], size[near], edits[near]
        backwards, _ = _padded([patterns.texts[i][::-1] for i in item[of[near]]])
        columns = np.arange(int((size + edits).max()))[None, :]
        text = stretch(ends[:, None] - 1 - columns, columns < (size + edits)[:, None], low, high)
        back = _last_rows(backwards, size, text, True)
        start = np.maximum(ends - back.argmin(axis=1), low)
        out.append(np.stack((row[of[near]], item[of[near]], start, np.minimum(ends, high), least[near]), axis=1))
    return np.unique(np.concatenate([np.zeros((0, 5), dtype=np.int64), *out]), axis=0)


class Spans:
    """Stretches of texts, for asking whether one of them holds others."""

    def __init__(self, found):
        # Sorted by text, item and first place; per text and item the farthest end so far.
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        edge = np.ones(len(found), dtype=bool)
        edge[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        self._from = np.append(np.flatnonzero(edge), len(found))
        self._names = {(r, i): k for k, (r, i) in enumerate(found[edge, :2].tolist())}
        self._starts, self._ends = found[:, 2].copy(), found[:, 3].copy()
        for low, high in zip(self._from[:-1], self._from[1:]):
            np.maximum.accumulate(self._ends[low:high], out=self._ends[low:high])

    def hold(self, row, item, start, end, beyond):
        """Whether one, made longer by ``beyond`` at both ends, holds each stretch."""
        held = np.zeros(len(row), dtype=bool)
        if not self._names or not len(row):
            return held
        pairs, which = np.unique(np.stack((row, item), axis=1), axis=0, return_inverse=True)
        for k, pair in enumerate(pairs.tolist()):
            name = self._names.get(tuple(pair))
            if name is not None:
                of = np.flatnonzero(which.reshape(-1) == k)
                low, high = self._from[name], self._from[name + 1]
                at = low + np.searchsorted(self._starts[low:high], start[of] + beyond, side="right") - 1
                held[of] = (at >= low) & (end[of] - beyond <= self._ends[np.maximum(at, low)])
        return held


def _last_rows(patterns, sizes, stretches, anchored):
    """The last row of the edit matrix of each pattern, as long as its size, and its stretch."""
    steps = np.arange(stretches.shape[1] + 1, dtype=np.int32)
    row = np.tile(steps if anchored else np.zeros_like(steps), (len(patterns), 1))
    last = row.copy()
    for i in range(patterns.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        np.minimum(row[:, :-1] + (stretches != patterns[:, i : i + 1]), row[:, 1:] + 1, out=new[:, 1:])
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        ended = sizes == i + 1
        if ended.any():
            last[ended] = row[ended]
    return last


def _distance(a, b):
    return int(_last_rows(a[None, :], np.array([len(a)]), b[None, :], True)[0, -1])


def _partial(codes, starts, candidates, index, whole):
    """Passages that are part of an item: neighbouring windows in one, outside whole items."""
    windows, step, size = index.windows, max(index.window // 3, 1), index.window
    window, row, first = candidates
    item, edits = windows.owners[window], int(windows.edits[0])
    outside = ~whole.hold(row, item, first, first + size, step)
    row, window, start, end, _ = _aligned(codes, starts, (window[outside], row[outside], first[outside]), windows).T
    hits = np.unique(np.stack((row, windows.owners[window], start, end, windows.places[window]), axis=1), axis=0)
    runs, open_runs, of = [], [], None
    for c in range(0, len(hits), 1 << 16):
        for r, i, start, end, place in hits[c : c + (1 << 16)].tolist():
            # Hits come in the order of their starts: what ended long before is complete.
            open_runs = [run for run in open_runs if start <= run[3] + step] if of == (r, i) else []
            of, slack = (r, i), 2 * edits
            for run in reversed(open_runs):
                apart = abs((place - run[6]) - (start - run[7]))
                drift = abs((place - run[4]) - (start - run[2]))
                if apart <= slack and drift <= slack + edits * (place - run[4]) // step and place >= run[6]:
                    run[3], run[5] = max(run[3], end), max(run[5], place + size)
                    run[6], run[7] = place, start
                    break
            else:
                runs.append([r, i, start, end, place, place + size, place, start])
                open_runs.append(runs[-1])
    for r, i, start, end, a, b, _, _ in runs:
        text = index.texts[i]
        while a and start > starts[r] and text[a - 1] == codes[start - 1]:
            a, start = a - 1, start - 1
        while b < len(text) and end < starts[r + 1] and text[b] == codes[end]:
            b, end = b + 1, end + 1
        yield r, i, start, end, _distance(text[a:b], codes[start:end])


def _short(codes, owner, index):
    """Items under the floor, exact and not within longer words."""
    joins = _joins_words(codes)
    inner = np.zeros(len(codes) + 1, dtype=bool)  # between two signs of one word
    inner[1:-1] = joins[1:] & joins[:-1] & (owner[1:] == owner[:-1])
    edges, sums, inverse = np.flatnonzero(~inner), _prefix_sums(codes), powers(len(codes) + 1, _INVERSE)
    for length, hashes in index.short_hashes.items():
        at = edges[edges + length <= len(codes)]
        at = at[~inner[at + length] & (owner[at] == owner[at + length - 1])]
        have = (sums[at + length] - sums[at]) * inverse[at]
        left, right = np.searchsorted(hashes, have), np.searchsorted(hashes, have, side="right")
        for n in np.flatnonzero(left < right):
            start = int(at[n])
            for k in range(left[n], right[n]):
                if np.array_equal(index.short_texts[length][k], codes[start : start + length]):
                    yield int(owner[start]), index.short_ids[length][k], start, start + length, 0


def _search(batches, index):
    names = [c.split()[0] for c in _MATCHES.split(", ")]
    types = [pa.int64()] * 4 + [pa.int32(), pa.string()]
    for batch in batches:
        for part in slices(batch, "text", 1 << 20):
            texts = [t or "" for t in part.column(1).to_pylist()]
            codes, owner, place = normalised(texts)
            if not len(codes):
                continue
            starts = np.searchsorted(owner, np.arange(len(texts) + 1))
            found = [np.zeros((0, 5), dtype=np.int64)]  # text, item, first place, place behind, edits
            if len(codes) >= index.q and len(index.keys):
                at, key = _hits(codes, owner, index)
                items = _aligned(codes, starts, _candidates(codes, owner, at, key, index.whole), index.whole)
                found.append(items)
                if index.windows:
                    whole = Spans(items)
                    parts = _candidates(codes, owner, at, key, index.windows)
                    parts = np.array(list(_partial(codes, starts, parts, index, whole)), dtype=np.int64).reshape(-1, 5)
                    # Windows at the edges of a whole item reach beyond it.
                    found.append(parts[~whole.hold(*parts.T[:4], index.window)])
            found = np.concatenate(found)
            found[:, 1] = index.ids[found[:, 1]]
            if index.short_hashes:
                short = np.array(list(_short(codes, owner, index)), dtype=np.int64).reshape(-1, 5)
                found = np.concatenate((found, short))
            found = np.unique(found, axis=0)
            ids = part.column(0)
            for low in range(0, len(found), 1 << 14):
                lines = []
                for row, item, start, end, cost in found[low : low + (1 << 14)].tolist():
                    start, end = int(place[start]), int(place[end - 1]) + 1
                    lines.append((ids[row].as_py(), item, start, end, cost, texts[row][start:end]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*lines), types)], names=names
                )


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    rate: float = 0.1,
    q: int = 8,
    min_chars: int = 40,
    slice_chars: int = 1 << 20,
    window: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Stretches of documents that are an item with at most ``rate`` edits per character; with
    ``window``, also stretches that are part of an item.

    Returns ``doc_id, item_id, start, end, edits, passage``: the stretch in code points of the
    original text. Texts are compared lower-cased and with white space as single spaces. Shared
    q-grams are counted per diagonal band; bands with as many as an occurrence must have are
    aligned. Items go to the tasks in slices of ``slice_chars`` characters (or one item), so what
    is broadcast is bounded; each slice is one pass over the documents.

    Items longer than ``window`` are also cut into windows of that many characters that begin at
    every third of it, each with its own edits. Windows that are found next to each other are one
    passage, as far as it goes on unedited; ``edits`` are those to the part of the item that it is.
    So every verbatim stretch of an item of ``4 * window / 3`` characters or more is found. Items
    with fewer than ``min_chars`` characters must occur unedited and not within longer words.

    Null and empty texts match nothing; items that are null or have a null id are left out. Items
    with equal texts are all reported; repeated rows are each searched, and a null document id
    stays. A text that repeats a stretch of an item over and over gives a passage for each place;
    memory follows its length, time the number of such places. With an empty table the result is
    empty; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    listed = items.select(
        F.col(item_id_col).cast("bigint").alias("id"), F.col(item_text_col).cast("string").alias("text")
    ).where("id is not null and text is not null")
    results, ids, texts, size = [], [], [], 0

    def search():
        index = build_index(ids, texts, q, rate, min_chars, window)
        results.append(rows.mapInArrow(partial(_search, index=index), _MATCHES))

    for item in listed.toLocalIterator():
        if texts and size + len(item["text"]) > slice_chars:
            search()
            results[-1] = stored(results[-1])  # the slice need not be held any longer
            ids, texts, size = [], [], 0
        ids.append(item["id"])
        texts.append(item["text"])
        size += len(item["text"])
    search()
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
