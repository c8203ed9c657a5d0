"""Substring dedup: passages of over 50 words that occur, nearly alike, in several documents.

Tokens are 5-word shingles; a passage of 50 words has WIDTH = 46 of them. For each of four hash
functions the Cartesian tree over a document's token hashes gives its compact windows: the
node of token i spans [l, r], and every subsequence between l and r that holds i has the hash of
i as its min-hash. Only nodes at least WIDTH wide matter; they form the top of the tree and are
found from the minima of all WIDTH-token windows. Inside a document an interval join of the
windows of two hash functions keeps the pairs that share a subsequence of WIDTH tokens; such a
pair stands for all subsequences with the same two min-hashes, its signature. Two pairs
of functions are used, so equal passages always share signatures.

Each document is compared, on whole texts, with the smallest document of each of its signatures
(the smallest one with the largest), unless smaller partners already hold all that the signature
stands for. A signature can lie in a frequent line that these documents share with the others and
nothing more, and likeness does not pass from one partner to the next. So subsequences that are in no
passage then, or in none of a smaller document that the signature has (`open`), are looked up again
among all members of their signatures. Equal ones meet by the hash of all their tokens. For the others
an exact filter comes first: at most ROOM tokens of an alike subsequence may be missing in its
partner, so of any ROOM + 1 of them one is there. Those that fewest of the members have are taken; where
more than ROOM are in no other member, there is no partner. The members that have one of the tokens taken are
compared in ascending order, a block in a round, until every open subsequence is settled or has
met all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import filled_text, shuffles_removed, staged
from .divergence import slices
from .shingles import mix, shingles, word_hashes, word_hashes_of

SHINGLE, PASSAGE_WORDS, SIMILARITY = 5, 50, 0.8
WIDTH = PASSAGE_WORDS - SHINGLE + 1
SEEDS = np.array([0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x9B05688C2B3E6C1F,
                  0x510E527FADE682D1], dtype=np.uint64)
FUNCTION_PAIRS = ((0, 1), (2, 3))
DRIFT = 8           # words that may be put in or left out inside a passage
SAME_SHIFT = 10     # of the common tokens, those that one shift must explain
POWER = 0xD1342543DE82EF95
BACK = pow(POWER, -1, 1 << 64)
FIRST_SHIFTS = 4    # tried before the rest is narrowed; sets speed only
MATCHES = 1 << 20   # looked at together; sets memory only
CACHE_TOKENS = 1 << 20
BLOCK = 4           # members met in the first round, each later one meets four times as many; sets speed only
#: Of WIDTH tokens so many must be common for a similarity of SIMILARITY.
COMMON = int(np.ceil(2 * WIDTH * SIMILARITY / (1 + SIMILARITY)))
ROOM = WIDTH - COMMON


def window_extremes(h: np.ndarray, width: int, largest: bool = False) -> np.ndarray:
    """Minimum (or maximum) of every `width` consecutive values, by block-wise running
    minima from both sides."""
    pick = np.maximum if largest else np.minimum
    n = len(h) - width + 1
    pad = -len(h) % width
    fill = np.zeros(pad, h.dtype) if largest else np.full(pad, np.iinfo(h.dtype).max)
    rows = np.concatenate([h, fill]).reshape(-1, width)
    ahead = pick.accumulate(rows, axis=1).ravel()
    back = pick.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n], ahead[width - 1:width - 1 + n])


def compact_windows(h: np.ndarray, width: int = WIDTH, ends: np.ndarray | None = None):
    """(anchors, starts): the Cartesian-tree nodes that span at least `width` tokens, and the first
    start of the `width`-token subsequences that each node's window stands for; the next node's
    first start ends them. h may hold several documents, one after another, that end at `ends`.

    A node is that wide exactly if its token is the minimum of some `width`-token window, and its
    ancestors are too, so the tree's top has these anchors alone. Of equal hashes the left one is
    the ancestor. A window [l, r] begins behind the last smaller or equal token: if that is the
    anchor before, subsequences start there; if the anchor before is larger, any smaller one is out
    of reach (its own subsequences lie between), and they start as soon as they hold the token.
    """
    if len(h) < width:
        return (np.empty(0, np.int64),) * 2
    ends = np.array([len(h)]) if ends is None else ends
    begins = np.concatenate(([0], ends[:-1]))
    low = window_extremes(h, width)
    across = (ends[:-1, None] - np.arange(1, width)).ravel()
    low[across[(across >= 0) & (across < len(low))]] = 0
    edge = np.zeros(width - 1, h.dtype)
    anchors = np.flatnonzero(
        window_extremes(np.concatenate([edge, low, edge]), width, largest=True) == h)
    document = np.searchsorted(ends, anchors, "right")
    long = ends[document] - begins[document] >= width
    anchors, document = anchors[long], document[long]
    values = h[anchors]
    starts = np.empty(len(anchors), np.int64)
    starts[1:] = np.where(values[1:] < values[:-1], anchors[1:] - width + 1, anchors[:-1] + 1)
    first = np.concatenate(([True], document[1:] != document[:-1]))[:len(anchors)]
    starts[first] = begins[document[first]]
    stops = np.minimum.accumulate(np.append(starts[1:], len(low))[::-1])[::-1][:len(anchors)]
    wide = starts < np.minimum(stops, ends[document] - width + 1)
    return anchors[wide], starts[wide]


def placed_signatures(tokens: np.ndarray, ends: np.ndarray | None = None):
    """(signature, start, stop): the hash of two min-hashes whose compact windows have a
    subsequence of WIDTH tokens in common, and where such subsequences start. The tokens may be those
    of several documents, one after another, that end at `ends`."""
    if len(tokens) < WIDTH:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.array([len(tokens)]) if ends is None else ends
    windows = []
    for seed in SEEDS:
        h = mix(tokens ^ seed)
        anchors, starts = compact_windows(h, WIDTH, ends)
        windows.append((starts, h[anchors]))
    out = []
    for f, g in FUNCTION_PAIRS:
        (start_f, low_f), (start_g, low_g) = windows[f], windows[g]
        both = np.sort(np.concatenate((start_f, start_g)), kind="stable")
        both = both[np.concatenate(([True], both[1:] != both[:-1]))[:len(both)]]
        a = low_f[np.searchsorted(start_f, both, "right") - 1]
        b = low_g[np.searchsorted(start_g, both, "right") - 1]
        last = ends[np.searchsorted(ends, both, "right")] - WIDTH + 1
        out.append((mix(a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(f)), both,
                    np.minimum(np.append(both[1:], len(tokens))[:len(both)], last)))
    return tuple(np.concatenate(c) for c in zip(*out))


def signatures(tokens: np.ndarray) -> np.ndarray:
    """Distinct signatures of a document."""
    return np.unique(placed_signatures(tokens)[0])


def window_hashes(t: np.ndarray) -> np.ndarray:
    """A hash of each window of WIDTH tokens, from running sums."""
    powers, backs = (np.cumprod(np.full(len(t), p, dtype=np.uint64)) for p in (POWER, BACK))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(t * powers)))
    return (total[WIDTH:] - total[:-WIDTH]) * backs[:len(t) - WIDTH + 1]


def placed(y: np.ndarray):
    """The distinct tokens of y and their places, and its windows: values, first, counts, places,
    sorted window hashes."""
    places = np.argsort(y, kind="stable")
    values = y[places]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))[:len(y)])
    return values[first], first, np.diff(first, append=len(y)), places, np.sort(window_hashes(y)) if len(y) >= WIDTH else None


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))[:len(values)]]


def _holding(places: np.ndarray, many: int, at: int, stop: int) -> np.ndarray:
    """Of the windows inside [at, stop), by their start, those that hold `many` of the places."""
    edges = np.zeros(stop - at - WIDTH + 2, dtype=np.int64)
    if len(places) < many:
        return edges[:-1] > 0
    begins, ends = places[:len(places) - many + 1], places[many - 1:]
    left, right = np.maximum(ends - WIDTH + 1, at), np.minimum(begins, stop - WIDTH)
    fits = left <= right
    np.add.at(edges, left[fits] - at, 1)
    np.add.at(edges, right[fits] + 1 - at, -1)
    return np.cumsum(edges)[:-1] > 0


def _in_ranges(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Of n places, those in one of the ranges, which may end behind them."""
    edges = np.bincount(np.minimum(starts, n), minlength=n + 1).astype(np.int64)
    return np.cumsum(edges - np.bincount(np.minimum(stops, n), minlength=n + 1))[:-1] > 0


def _mark(alike: np.ndarray, possible: np.ndarray, here: np.ndarray, shift: np.ndarray, at: int,
          most: int | None = None) -> None:
    """Add to `alike` the possible windows that one of the shifts explains, the `most` frequent
    ones or all."""
    by_shift = np.lexsort((here, shift))
    here, shift = here[by_shift], shift[by_shift]
    many, stop = SAME_SHIFT - 1, at + len(alike) + WIDTH - 1
    dense = (shift[many:] == shift[:-many]) & (here[many:] - here[:-many] < WIDTH)
    shifts, counts = np.unique(shift[:-many][dense], return_counts=True)
    low, first, last, high = np.searchsorted(
        shift, shifts + np.array((-DRIFT, 0, 1, DRIFT + 1))[:, None])
    likely = high - low >= COMMON
    order = np.argsort(-counts[likely], kind="stable")[:most]
    rest = possible & ~alike
    for low, first, last, high in np.stack((low, first, last, high), 1)[likely][order].tolist():
        begin, end = max(int(here[first]) - WIDTH + 1, at), min(int(here[last - 1]) + WIDTH, stop)
        part = slice(begin - at, end - WIDTH + 1 - at)
        asked = rest[part]
        if not asked.any():
            continue
        asked = asked & _holding(here[first:last], SAME_SHIFT, begin, end)
        own = here[low:high]
        own = _distinct(own[(own >= begin) & (own < end)])
        if len(own) >= COMMON and asked.any():
            asked &= _holding(own, COMMON, begin, end)
            alike[part] |= asked
            rest[part] &= ~asked


def _in_dense_bands(here: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Which matches lie in a band of 3 * DRIFT shifts where some WIDTH tokens hold COMMON matched
    ones. Bands begin at each multiple of DRIFT, so that one of them holds any shift's drift."""
    band = (shift - shift.min()) // DRIFT + 2
    wide = int(here.max()) + WIDTH + 1
    keys = _distinct(np.concatenate([(band - k) * wide + here for k in range(3)]))
    many = COMMON - 1
    dense = np.zeros(int(band.max()) + 1, dtype=bool)
    dense[keys[:-many][keys[many:] - keys[:-many] < WIDTH] // wide] = True
    return dense[band] | dense[band - 1] | dense[band - 2]


def _alike(here: np.ndarray, there: np.ndarray, at: int, stop: int) -> np.ndarray:
    """Of the windows inside [at, stop), by their start, those with SAME_SHIFT matches (here,
    there) of one shift and COMMON tokens matched with this shift but for DRIFT. A window's answer
    depends on its own matches alone."""
    alike = np.zeros(stop - at - WIDTH + 1, dtype=bool)
    possible = _holding(np.flatnonzero(np.bincount(here)), COMMON, at, stop)
    shift = there - here
    _mark(alike, possible, here, shift, at, FIRST_SHIFTS)     # they often explain all
    rest = np.flatnonzero(possible & ~alike)
    if len(rest):
        inside = _in_ranges(rest, rest + WIDTH, stop - at)[here - at]
        here, shift = here[inside], shift[inside]
        dense = _in_dense_bands(here, shift)
        _mark(alike, possible, here[dense], shift[dense], at)
    return alike


def _spans(found: np.ndarray) -> list[tuple[int, int]]:
    """Word ranges of runs of windows."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], found.view(np.int8), [0]))))
    return [(int(s), int(e) - 1 + WIDTH + SHINGLE - 1) for s, e in zip(edges[::2], edges[1::2])]


def _matches(x: np.ndarray, in_y):
    values, first, counts, *_ = in_y
    k = np.minimum(np.searchsorted(values, x), len(values) - 1)
    return first[k], np.where(values[k] == x, counts[k], 0)


def _pairs(first, many, places, at: int, stop: int):
    n = many[at:stop]
    here = np.repeat(np.arange(at, stop), n)
    nth = np.arange(len(here)) - np.repeat(np.cumsum(n) - n, n)
    return here, places[np.repeat(first[at:stop], n) + nth]


def alike_windows(x: np.ndarray, y: np.ndarray, in_y=None) -> np.ndarray:
    """Which WIDTH-token windows of x, by their start, y has nearly alike: COMMON of their tokens
    occur in y in the same order but for DRIFT places. Windows that y has exactly need no more;
    in the others, a token is matched with all its places in y, and a stretch of x with about
    MATCHES matches is looked at at a time."""
    found = np.zeros(max(len(x) - WIDTH + 1, 0), dtype=bool)
    if len(x) < WIDTH or len(y) < WIDTH:
        return found
    in_y = in_y or placed(y)
    first, many = _matches(x, in_y)
    if np.count_nonzero(many) < COMMON:
        return found
    possible = _holding(np.flatnonzero(many), COMMON, 0, len(x))
    own, windows = window_hashes(x), in_y[4]
    found = windows[np.minimum(np.searchsorted(windows, own), len(windows) - 1)] == own
    rest = np.flatnonzero(possible & ~found)
    if not len(rest):
        return found
    many = np.where(_in_ranges(rest, rest + WIDTH, len(x)), many, 0)
    total = np.concatenate(([0], np.cumsum(many)))
    at = stop = 0
    while stop < len(x):
        at = max(0, stop - WIDTH + 1)
        stop = min(len(x), max(at + 2 * WIDTH,
                               int(np.searchsorted(total, total[at] + MATCHES, "right")) - 1))
        if total[stop] - total[at] >= COMMON:
            found[at:stop - WIDTH + 1] |= _alike(*_pairs(first, many, in_y[3], at, stop), at, stop)
    return found


def passages(x: np.ndarray, y: np.ndarray, in_y=None) -> list[tuple[int, int]]:
    """Word ranges [start, end) of x that y has nearly alike."""
    return _spans(alike_windows(x, y, in_y))


def _tokens(text: str) -> np.ndarray:
    w = word_hashes(text)
    return shingles(w, SHINGLE) if len(w) >= SHINGLE else np.empty(0, np.uint64)


def _token_rows(texts: pa.Array):
    """(tokens, ends): the tokens of all texts, one text after another."""
    w, ends = word_hashes_of(texts)
    if len(w) < SHINGLE:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    counts = np.diff(ends, prepend=0)
    whole = np.repeat(ends, counts)[:len(w) - SHINGLE + 1] >= np.arange(SHINGLE, len(w) + 1)
    return shingles(w, SHINGLE)[whole], np.cumsum(np.maximum(counts - SHINGLE + 1, 0))


def _token_lists(texts: pa.Array):
    """The tokens of each text."""
    for part in slices([pa.RecordBatch.from_arrays([texts], names=["text"])]):
        tokens, ends = _token_rows(part.column("text"))
        yield from np.split(tokens, ends[:-1])


def _signed_lists(texts: pa.Array):
    """The tokens of each text and its placed_signatures."""
    for part in slices([pa.RecordBatch.from_arrays([texts], names=["text"])]):
        tokens, ends = _token_rows(part.column("text"))
        begins = np.concatenate(([0], ends[:-1]))
        signs, starts, stops = placed_signatures(tokens, ends)
        row = np.searchsorted(ends, starts, "right")
        by_row = np.argsort(row, kind="stable")
        row, signs, starts, stops = (c[by_row] for c in (row, signs, starts, stops))
        starts, stops = starts - begins[row], stops - begins[row]
        cuts = np.searchsorted(row, np.arange(1, len(ends)))
        yield from zip(np.split(tokens, ends[:-1]), zip(*(np.split(c, cuts) for c in (signs, starts, stops))))


def _signature_rows(batches):
    for batch in slices(batches):
        tokens, ends = _token_rows(batch.column("text"))
        signs, starts, _ = placed_signatures(tokens, ends)
        if not len(signs):
            continue
        rows = np.searchsorted(ends, starts, "right")
        by_row = np.lexsort((signs, rows))
        rows, signs = rows[by_row], signs[by_row]
        new = np.concatenate(([True], (rows[1:] != rows[:-1]) | (signs[1:] != signs[:-1])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(signs[new].view(np.int64)), batch.column("doc_id").take(pa.array(rows[new]))],
            names=["sig", "doc_id"])


def _runs(flags: np.ndarray):
    """(start, stop) of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


class _Compared:
    """A document: which of its windows are in a passage of any other document (`covered`), and of a
    smaller one."""

    def __init__(self, doc_id: int, x: np.ndarray, placed_signs):
        self.doc_id, self.x, self.signs, n = doc_id, x, placed_signs, max(len(x) - WIDTH + 1, 0)
        self.covered, self.smaller = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)

    def settled(self, asked: np.ndarray, other_id: int) -> bool:
        return bool((self.smaller if other_id < self.doc_id else self.covered)[asked].all())

    def add(self, found: np.ndarray, other_id: int) -> None:
        self.covered |= found
        if other_id < self.doc_id:
            self.smaller |= found


def _rows(batches):
    """(document, other_id, found, places) of each row (doc_id, text, other_id, other, places), sorted by
    document; found() compares the two texts."""
    known: dict = {}
    size, last, doc = 0, None, None

    def other(text):
        nonlocal size
        if text not in known:
            y = _tokens(text)
            size += len(y)
            if size > CACHE_TOKENS:
                known.clear()
                size = len(y)
            known[text] = y, placed(y) if len(y) else None
        return known[text]

    for batch in batches:
        distinct = batch.column(1).unique()
        tokens = dict(zip(distinct.to_pylist(), _signed_lists(distinct)))
        places = batch.column(4)
        cuts = places.offsets.to_numpy() - places.offsets[0].as_py()
        fields = {f.name: places.flatten().field(f.name).to_numpy(zero_copy_only=False)
                  for f in places.type.value_type}
        for doc_id, x, other_id, y, a, b in zip(
                *[batch.column(c).to_pylist() for c in range(4)], cuts[:-1], cuts[1:]):
            if last != (doc_id, x):
                last, doc = (doc_id, x), _Compared(doc_id, *tokens[x])

            def found():
                if x == y:
                    return np.ones(len(doc.covered), dtype=bool)
                return alike_windows(doc.x, *other(y))
            yield doc, other_id, found, {name: column[a:b] for name, column in fields.items()}


CHECKED = ("doc_id bigint, other_id bigint, start bigint, end bigint, key bigint, kind int, "
           "larger boolean")
CHECKED_NAMES = ["doc_id", "other_id", "start", "end", "key", "kind", "larger"]
SPAN, WINDOW, SIGNATURE, TOKEN = range(4)


def _checked(doc: _Compared, kind: int, other_id=None, start=None, end=None, key=None, larger=None):
    """Rows of one kind: passages, open windows with their hash, signatures and tokens of open windows.
    `larger`: the window is in a passage, of larger documents only."""
    columns = (start, end, key, larger)
    n = len(next(c for c in columns if c is not None))
    types = [pa.int64()] * 3 + [pa.bool_()]
    start, end, key, larger = (pa.nulls(n, t) if c is None else pa.array(c, t)
                               for c, t in zip(columns, types))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, doc.doc_id)),
         pa.nulls(n, pa.int64()) if other_id is None else pa.array(np.full(n, other_id)),
         start, end, key, pa.array(np.full(n, kind, np.int32)), larger], names=CHECKED_NAMES)


def _span_rows(doc, found, other_id):
    spans = _spans(found)
    if spans:
        yield _checked(doc, SPAN, other_id, *zip(*spans))


def _gathered(batches):
    """The batches in fewer, larger ones."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= 10_000 or len(held) >= 1_000:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _verify(batches):
    """The passages of documents with the partners of their signatures, and what is open after them."""
    return _gathered(_verified(batches))


def _verified(batches):
    doc = shared = passed = None        # windows of signatures with more than two rows, and with smaller members

    def left_open():
        if doc is None or not shared.any():
            return
        none, only_larger = shared & ~doc.covered, passed & doc.covered & ~doc.smaller
        is_open = none | only_larger
        if not is_open.any():
            return
        at = np.flatnonzero(is_open)
        yield _checked(doc, WINDOW, start=at, key=window_hashes(doc.x)[at].view(np.int64),
                       larger=only_larger[at])
        total = np.concatenate(([0], np.cumsum(is_open)))
        yield _checked(doc, SIGNATURE, key=np.unique(signs[several & (total[stops] > total[starts])]).view(np.int64))

    for own, other_id, found, places in _rows(batches):
        if own is not doc:
            yield from left_open()
            doc = own
            signs, starts, stops = doc.signs
            shared, passed = (np.zeros(len(doc.covered), dtype=bool) for _ in range(2))
            several = np.zeros(len(signs), dtype=bool)
        keys = places["sig"].view(np.uint64)
        order = np.argsort(keys)
        k = order[np.minimum(np.searchsorted(keys, signs, sorter=order), len(keys) - 1)]
        here = keys[k] == signs
        asked = _in_ranges(starts[here], stops[here], len(doc.covered))
        many = here & places["several"][k].astype(bool)
        if many.any():
            several |= many
            of_several = _in_ranges(starts[many], stops[many], len(doc.covered))
            shared |= of_several
            if other_id < doc.doc_id:
                passed |= of_several
        if doc.settled(asked, other_id):
            continue
        alike = found()
        doc.add(alike, other_id)
        yield from _span_rows(doc, alike, other_id)
    yield from left_open()


def _verify_again(batches):
    """The passages of documents with the members that have a token taken, and the tokens of windows
    that are open after them."""
    return _gathered(_verified_again(batches))


def _verified_again(batches):
    doc, asked_for = None, set()

    def left_open():
        left = []
        for key, start, stop, larger in sorted(asked_for):
            part = slice(start, stop)
            for begin, end, flag in [
                    (*r, larger) for r in zip(*_runs(~doc.covered[part]))] + [
                    (*r, True) for r in zip(*_runs(doc.covered[part] & ~doc.smaller[part]))]:
                left.append((start + int(begin), start + int(end), key, flag))
        if left:
            yield _checked(doc, TOKEN, None, *zip(*left))

    for own, other_id, found, places in _rows(batches):
        if own is not doc:
            yield from left_open()
            doc, asked_for = own, set()
        places = [(k, a, min(b, len(doc.covered)), bool(n)) for k, a, b, n in zip(
            *(places[c].tolist() for c in ("key", "start", "stop", "larger"))) if a < len(doc.covered)]
        asked_for.update(places)
        if all(doc.settled(slice(a, b), other_id) for _, a, b, _ in places):
            continue
        alike = found()
        doc.add(alike, other_id)
        yield from _span_rows(doc, alike, other_id)
    yield from left_open()


def _member_tokens(batches):
    """(token, doc_id): the distinct tokens of the windows of some signatures."""
    return _gathered(_tokens_of_members(batches))


def _tokens_of_members(batches):
    for batch in batches:
        for doc_id, (x, (own, starts, stops)), signs in zip(
                batch.column(0).to_pylist(), _signed_lists(batch.column(1)), batch.column(2)):
            here = np.isin(own, signs.values.to_numpy().view(np.uint64))
            if here.any():
                tokens = _distinct(x[_in_ranges(starts[here], stops[here] + WIDTH - 1, len(x))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(np.full(len(tokens), doc_id))],
                    names=["token", "doc_id"])


def rare_tokens(x: np.ndarray, starts: np.ndarray, tokens: np.ndarray, members: np.ndarray):
    """(start, token) of the windows of x at `starts`: of each, those of the ROOM + 1 tokens with the
    fewest other members that have any. `tokens` have `members` of them, other tokens none."""
    rank = np.empty(len(tokens), np.int64)
    rank[np.lexsort((tokens, members))] = np.arange(len(tokens))
    order = np.argsort(tokens)
    k = order[np.minimum(np.searchsorted(tokens, x, sorter=order), len(tokens) - 1)]
    ranks = np.where(tokens[k] == x, rank[k], -1)
    windows = np.lib.stride_tricks.sliding_window_view(ranks, WIDTH)
    taken = [np.partition(windows[starts[i:i + (1 << 16)]], ROOM, axis=1)[:, :ROOM + 1]
             for i in range(0, len(starts), 1 << 16)]
    taken = np.concatenate(taken)
    at = np.broadcast_to(starts[:, None], taken.shape)[taken >= 0]
    return at, tokens[np.argsort(rank)][taken[taken >= 0]]


def _probes(batches):
    """Rows of _taken in fewer batches."""
    return _gathered(_taken(batches))


def _taken(batches):
    """(key, doc_id, start, stop, larger): the tokens taken of each document's open windows (doc_id, text,
    windows, tokens), and the runs of windows that they are taken for."""
    for batch in batches:
        for doc_id, x, opened, found in zip(batch.column(0).to_pylist(), _token_lists(batch.column(1)),
                                            batch.column(2), batch.column(3)):
            starts, larger = (opened.values.field(c).to_numpy(zero_copy_only=False) for c in ("start", "larger"))
            inside = starts + WIDTH <= len(x)
            starts, first = np.unique(starts[inside], return_index=True)
            if not len(starts):
                continue
            larger = larger[inside].astype(bool)[first]
            tokens, members = (found.values.field(c).to_numpy() for c in ("token", "members"))
            tokens, first = np.unique(tokens.view(np.uint64), return_index=True)
            at, token = rare_tokens(x, starts, tokens, members[first])
            if not len(at):
                continue
            rows = np.unique(np.rec.fromarrays([token, larger[np.searchsorted(starts, at)], at]))
            token, flag, at = (rows[c] for c in rows.dtype.names)
            new = np.concatenate(([True], (token[1:] != token[:-1]) | (flag[1:] != flag[:-1])
                                  | (at[1:] != at[:-1] + 1)))
            last = np.concatenate((new[1:], [True]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[new].view(np.int64)), pa.array(np.full(int(new.sum()), doc_id)),
                 pa.array(at[new].astype(np.int32)), pa.array((at[last] + 1).astype(np.int32)),
                 pa.array(flag[new])], names=["key", "doc_id", "start", "stop", "larger"])


def _staged(spark, df: DataFrame, name: str) -> DataFrame:
    """`staged` with little disk: the shuffle files of one step are gone before the next begins."""
    with shuffles_removed(spark):
        return staged(spark, df, name, compression="zstd")


def _partners(members: DataFrame, key: str, name: str, how: str = "inner") -> DataFrame:
    """Rows of members whose key several documents have (or all, with `how` left), with the smallest of these
    (the smallest one with the largest) as other_id, and `several` if the key has more than two rows. The
    groups are written first, so that the join can split a key that many rows have."""
    groups = _staged(members.sparkSession, members.groupBy(key).agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        (F.count(F.lit(1)) > 2).alias("several")).filter("low < high"), name)
    return members.join(groups, key, how).withColumn(
        "other_id", F.when(F.col("doc_id") == F.col("low"), F.col("high")).otherwise(F.col("low")))


def _compared(pairs: DataFrame, texts: DataFrame, verify) -> DataFrame:
    other = texts.select(F.col("doc_id").alias("other_id"), F.col("text").alias("other"))
    # a document's partners meet in one task, one text at a time: they are no more than its windows
    return (pairs.join(other, "other_id").repartition("doc_id").join(texts, "doc_id")
            .select("doc_id", "text", "other_id", "other", "places")
            .sortWithinPartitions("doc_id", F.xxhash64("text"), "other_id")
            .mapInArrow(verify, CHECKED))


def _met(windows: DataFrame, members: DataFrame, texts: DataFrame):
    """The passages of open windows (doc_id, windows) with any of the members (doc_id, sigs) of their
    signatures."""
    spark = texts.sparkSession
    tokens = _staged(spark, texts.join(members, "doc_id").select("doc_id", "text", "sigs").mapInArrow(
        _member_tokens, "token bigint, doc_id bigint"), "member_tokens")
    shared = tokens.groupBy("token").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        F.count(F.lit(1)).alias("members")).filter("low < high").select("token", "members")
    of_document = tokens.join(_staged(spark, shared, "shared_tokens"), "token").groupBy("doc_id").agg(
        F.collect_list(F.struct("token", "members")).alias("tokens"))
    left = _staged(spark, texts.join(windows, "doc_id").join(of_document, "doc_id").select(
        "doc_id", "text", "windows", "tokens").mapInArrow(
        _probes, "key bigint, doc_id bigint, start int, stop int, larger boolean"), "rare_tokens")
    met = _staged(spark, tokens.withColumnRenamed("token", "key").join(
        left.select("key").distinct(), "key", "left_semi").distinct().select(
        "key", F.col("doc_id").alias("other_id"), F.row_number().over(
            Window.partitionBy("key").orderBy("doc_id")).alias("nth")), "rare_members")
    first, behind = 1, 1 + BLOCK
    while not left.isEmpty():
        pairs = left.join(met.filter(F.col("nth").between(first, behind - 1)), "key").filter(
            "other_id <> doc_id AND (other_id < doc_id OR NOT larger)").groupBy("doc_id", "other_id").agg(
            F.collect_list(F.struct("key", "start", "stop", "larger")).alias("places"))
        checked = _staged(spark, _compared(pairs, texts, _verify_again), "passages_met")
        yield checked.filter(F.col("kind") == SPAN)
        left = checked.filter(F.col("kind") == TOKEN).select(
            "key", "doc_id", F.col("start").cast("int").alias("start"),
            F.col("end").cast("int").alias("stop"), "larger")
        first, behind = behind, behind + 4 * (behind - first)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word, first_doc_id, removable: one row per passage.

    Words count from 0, end_word is exclusive; words are cut at blanks and the characters 9 to
    13, A-Z lower-cased. first_doc_id is the smallest document the passage was verified
    against; it is removable if that is smaller than its own. Overlapping finds of a document
    are joined. Null, empty and short texts (under PASSAGE_WORDS words) have no passage. Rows
    without an id take no part; rows that repeat an id are compared as one document's
    versions, not with each other. Repetition inside one document is not reported. Whole texts are
    read; other columns are not.
    """
    spark = docs.sparkSession
    texts = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         filled_text().cast("string").alias("text")).filter("doc_id IS NOT NULL"))
    rows = _staged(spark, texts.mapInArrow(_signature_rows, "sig bigint, doc_id bigint"), "signatures")
    pairs = _staged(spark, _partners(rows, "sig", "passage_groups").groupBy("doc_id", "other_id").agg(
        F.collect_list(F.struct("sig", "several")).alias("places")), "passage_pairs")
    # every partner is a member too; the hint keeps this join alike at every size
    texts = _staged(spark, texts.join(pairs.select("doc_id").distinct().hint("merge"), "doc_id",
                                     "left_semi"), "passage_texts")
    checked = _staged(spark, _compared(pairs, texts, _verify), "passages_checked")
    again = _staged(spark, _partners(
        checked.filter(F.col("kind") == WINDOW).select("doc_id", "start", "key", "larger"), "key",
        "passage_keys", "left"), "passages_open")
    equal = again.filter("low IS NOT NULL").select(
        "doc_id", "other_id", "start", (F.col("start") + WIDTH + SHINGLE - 1).alias("end"))
    windows = again.filter("low IS NULL OR low = doc_id").groupBy("doc_id").agg(F.collect_list(F.struct(
        "start", (F.col("larger") | F.col("low").isNotNull()).alias("larger"))).alias("windows"))
    open_signs = checked.filter(F.col("kind") == SIGNATURE).select(F.col("key").alias("sig")).distinct()
    members = (pairs.select("doc_id", F.explode("places").alias("p")).filter("p.several")
               .select("doc_id", "p.sig").join(open_signs, "sig", "left_semi")
               .groupBy("doc_id").agg(F.collect_list("sig").alias("sigs")))
    found = checked.filter(F.col("kind") == SPAN)
    for more in _met(windows, members, texts):
        found = found.unionByName(more)
    return joined_spans(_smallest(found.select("doc_id", "other_id", "start", "end").unionByName(equal)))


def _smallest(found: DataFrame) -> DataFrame:
    return found.groupBy("doc_id", "start", "end").agg(F.min("other_id").alias("first_doc_id"))


def joined_spans(found: DataFrame) -> DataFrame:
    """Join overlapping ranges of a document. What is grouped is bounded by its length."""
    item = F.struct("start", "end", "first_doc_id")
    empty = "array<struct<start:bigint,end:bigint,first_doc_id:bigint>>"
    merged = F.aggregate(
        F.array_sort(F.collect_list(item)), F.array().cast(empty),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > x["start"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
                F.least(F.element_at(acc, -1)["first_doc_id"], x["first_doc_id"])
                .alias("first_doc_id")))))
        .otherwise(F.concat(acc, F.array(x))))
    return (found.groupBy("doc_id").agg(merged.alias("spans"))
            .select("doc_id", F.explode("spans").alias("s"))
            .select("doc_id", F.col("s.start").alias("start_word"), F.col("s.end").alias("end_word"),
                    F.col("s.first_doc_id").alias("first_doc_id"),
                    (F.col("s.first_doc_id") < F.col("doc_id")).alias("removable")))
