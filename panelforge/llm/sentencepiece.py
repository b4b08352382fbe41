"""SentencePiece encoding and decoding of whole texts, by Viterbi in lockstep, batched in numpy.

A text is cut into units, blanks followed by other characters; no piece spans two units. Distinct units
of a batch are encoded together, all of one length at a time: their characters are the rows of a
matrix and advance in lockstep. At each end position the hashes of all substrings that end there
probe the sorted piece keys; the maximum over starts is stored with its backpointer; paths are then
read from the last position back. The two kinds of model differ in what a start scores:

* unigram: the piece's score and the best score up to its start;
* BPE, where a score is the rank of a merge and sums of scores mean nothing: 0 if the merges would leave the
  piece beside the one that ends at its start, and minus infinity if not. A sequence is what the
  merges make of a text if and only if each two neighbours are what they make of these two, so one
  start scores 0 at every end, and the path is the merges' result. Neighbours are looked
  at by undoing their merges, the latest first: each time the symbols at the border must not merge before.

Few units of a length share a matrix with those of lengths near it, their rows padded. A long unit of a BPE model is cut
into lanes, which are rows like any other and overlap: what ends at a place follows from what ends at the places before
it, as far back as the longest piece goes, so two lanes that agree at so many places in a row agree from there on, and
the later one goes on for both. Where lanes that overlap don't come to agree (a text of one period), the unit is cut anew into lanes four times
as long, at last into one, which takes 0.4 ms a character. Long units of a unigram model are one row. Both models give the ids that the library gives. The model file is a parameter; it is read where it is
used and never copied. Decoding restores the text; a U+2581 in a text comes back as a blank, and
an unpaired surrogate cannot occur in a Spark string.

Defined results: a null or empty text has no ids and decodes to an empty text; null ids decode to an
empty text; rows are independent of each other, so repeated ones get the same ids; a very long text is encoded
whole, in memory of some 100 bytes a character; an empty table gives no rows; other columns are
carried or ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructType

from panelforge.llm.common import bounded_batches, carried, unpacked
from panelforge.llm.textvec import mixed

MARK = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
FEW_UNITS = 16  # units of one length that share a matrix with those of other lengths
LANE = 512  # characters of a long unit that advance as one row
OVERLAP = 8  # of lanes, in longest pieces
STEP = 0x9E3779B97F4A7C15
BLOCK_UNITS = 1 << 15
BLOCK_CELLS = 1 << 19
UNITS = re.compile(f"{MARK}+[^{MARK}]*")


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two symbols, different for different pairs."""
    return mixed((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64))


class _Table:
    """Sorted keys, which are hashes, with their values. A table of one bit per hash spares most misses the search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.flags = np.zeros(1 << 20, bool)
        self.flags[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        out = np.full(keys.shape, -1, np.int64)
        if not len(self.keys):
            return out
        near = np.flatnonzero(self.flags[(keys >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, keys[near]), len(self.keys) - 1)
        hit = self.keys[at] == keys[near]
        out[near[hit]] = self.values[at[hit]]
        return out


class Pieces:
    """The pieces of a model, as sorted keys for vectorised look-up."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str], unigram: bool):
        """kinds: normal, byte or other (control, unknown: never made from text).

        A character is a symbol: its id, or the number of pieces plus its code point where it is
        no piece of its own.
        """
        self.pieces, self.kinds, self.unigram = pieces, kinds, unigram
        self.ids = {p: i for i, p in enumerate(pieces) if kinds[i] == "normal"}
        self.scores = np.array(scores, np.float64)
        self.unknown = pieces.index("<unk>") if "<unk>" in pieces else 0
        self.bytes = np.full(256, self.unknown, np.int64)
        for i, p in enumerate(pieces):
            if kinds[i] == "byte":
                self.bytes[int(p[3:5], 16)] = i
        self.fallback = "byte" in kinds
        self.longest = max((len(p) for p in self.ids), default=1)
        self.lowest = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0  # of a character that is no piece
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("a piece goes on after a blank; units of such a model can't be encoded alone")
        self.symbol = np.arange(0x110000, dtype=np.int32) + len(pieces)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        # pieces, and with value -2 what is only the beginning of a piece
        begun = {p[:k] for p in self.ids for k in range(1, len(p))}.difference(self.ids)
        self.table = _Table(self._string_keys([*self.ids, *begun]), np.array([*self.ids.values(), *[-2] * len(begun)], np.int64))
        if not unigram:
            self._learn_merges()

    def _learn_merges(self) -> None:
        """Which two symbols make a piece, each piece's rank (-1: no merge), and the two halves of its last merge.

        From short pieces to long ones: the halves are those that the merges ranked before the piece
        leave side by side. A piece without such halves is never made.
        """
        n = len(self.pieces)
        one = lambda x: int(self.symbol[ord(x)]) if len(x) == 1 else self.ids.get(x)
        cuts = [(len(p), i, one(p[:k]), one(p[k:])) for p, i in self.ids.items() for k in range(1, len(p)) if one(p[:k]) is not None and one(p[k:]) is not None]
        cuts = np.array(cuts, np.int64).reshape(-1, 4)
        self.pair_table = _Table(_pair(cuts[:, 2], cuts[:, 3]), cuts[:, 1])
        self.rank = np.full(n, -1, np.int64)
        whole = [i for p, i in self.ids.items() if len(p) > 1]
        self.rank[whole] = np.round(-self.scores[whole]).astype(np.int64)
        self.halves = np.full((n, 2), -1, np.int64)
        self.made = np.zeros(n, bool)
        self.made[[i for p, i in self.ids.items() if len(p) == 1]] = True
        for size in np.unique(cuts[:, 0]):
            _, i, a, b = cuts[cuts[:, 0] == size].T
            ok = self._is_made(a) & self._is_made(b)
            i, a, b = i[ok], a[ok], b[ok]
            ok = self.stay_apart(a, b, self.rank[i])
            self.halves[i[ok]] = np.stack((a[ok], b[ok]), 1)
            self.made[i[ok]] = True
        self.known, self.known_apart = np.zeros(1 << 20, np.uint64), np.zeros(1 << 20, bool)

    def are_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`stay_apart` by way of a table of the pairs met last."""
        key = _pair(a, b)
        slot = (key >> np.uint64(44)).astype(np.int64)
        new = np.flatnonzero(self.known[slot] != key)
        out = self.known_apart[slot]
        if len(new):
            out[new] = self.stay_apart(a[new], b[new])
            self.known[slot[new]] = key[new]
            # of pairs that share a slot the one that was written last is kept
            last = self.known[slot[new]] == key[new]
            self.known_apart[slot[new[last]]] = out[new[last]]
        return out

    def _is_made(self, symbols: np.ndarray) -> np.ndarray:
        return (symbols >= len(self.pieces)) | self.made[np.minimum(symbols, len(self.pieces) - 1)]

    def _rank(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < len(self.pieces), self.rank[np.minimum(symbols, len(self.pieces) - 1)], -1)

    def stay_apart(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether the merges (those ranked before `before`, if given) leave a and b side by side.

        A merge over the border counts if its rank comes before the event that takes one of its sides
        away; among equal ranks the left one is first.
        """
        out, live = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), np.iinfo(np.int64).max) if before is None else before
        while len(live):
            over = self.pair_table.look_up(_pair(a, b))
            joins = (over >= 0) & (self.rank[over] < limit)
            out[live[joins]] = False
            x, y = self._rank(a), self._rank(b)
            on = ~joins & ((x >= 0) | (y >= 0))
            live, a, b, x, y = live[on], a[on], b[on], x[on], y[on]
            left = x > y  # what was made last is undone first
            limit = np.where(left, x, y + 1)
            a, b = np.where(left, self.halves[np.where(left, a, 0), 1], a), np.where(left, b, self.halves[np.where(left, 0, b), 0])
        return out

    @staticmethod
    def load(path: str) -> Pieces:
        return _load(path)

    @staticmethod
    def _string_keys(strings: list[str]) -> np.ndarray:
        sizes = np.array([len(x) for x in strings], np.int64)
        out, at = np.zeros(len(strings), np.uint64), np.concatenate(([0], np.cumsum(sizes)))[:-1]
        points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        for k in range(int(sizes.max(initial=0))):
            on = np.flatnonzero(sizes > k)
            out[on] = mixed(out[on] * np.uint64(STEP) + points[at[on] + k])
        return out

    def spelled(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, and how many each unit has: characters that are no piece give their bytes."""
        odd = np.flatnonzero(symbols >= len(self.pieces))
        if not len(odd):
            return symbols, sizes
        given = [[int(self.bytes[b]) for b in chr(c).encode()] if self.fallback else [self.unknown] for c in (symbols[odd] - len(self.pieces)).tolist()]
        times = np.ones(len(symbols), np.int64)
        times[odd] = [len(g) for g in given]
        stop = np.cumsum(times)
        ids = np.repeat(symbols, times)
        for i, g in zip(odd.tolist(), given):
            ids[stop[i] - len(g) : stop[i]] = g
        return ids, np.diff(np.concatenate(([0], stop))[np.concatenate(([0], np.cumsum(sizes)))])


@lru_cache(maxsize=2)
def _load(path: str) -> Pieces:
    import sentencepiece as library

    m = library.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    kinds = ["byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "normal" for i in range(n)]
    # normalisation other than the mark for blanks would have to be applied first
    if m.normalize("a  ﬁ①\n ") != f"{MARK}a{MARK}{MARK}ﬁ①\n{MARK}":
        raise ValueError(f"{path} normalises text in a way that isn't supported")
    pieces, scores = [m.id_to_piece(i) for i in range(n)], [m.get_score(i) for i in range(n)]
    # in a BPE model every score is the negative of a whole number, the rank of the merge
    unigram = any(s != round(s) for s, k in zip(scores, kinds) if k == "normal")
    return Pieces(pieces, scores, kinds, unigram)


def _viterbi(model: Pieces, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For units of one length, or padded to it, what ends at each place and where it begins; points: code points."""
    rows = model.symbol[points].astype(np.int64)
    n, width = points.shape
    best = np.full((n, width + 1), -np.inf)
    best[:, 0] = 0
    back, piece = np.zeros((n, width + 1), np.int64), np.full((n, width + 1), -1, np.int64)
    r = np.arange(n)
    # substrings up to the current end that begin a piece: unit, start, hash
    unit, start, h = (np.zeros(0, t) for t in (np.int64, np.int64, np.uint64))
    for end in range(1, width + 1):
        unit, start, h = np.concatenate((unit, r)), np.concatenate((start, np.full(n, end - 1))), np.concatenate((h, np.zeros(n, np.uint64)))
        h = mixed(h * np.uint64(STEP) + points[unit, end - 1] + np.uint64(1))
        ids = model.table.look_up(h)
        single = np.arange(len(ids)) >= len(ids) - n
        piece_here = np.flatnonzero((ids >= 0) | single)
        u, s, i = unit[piece_here], start[piece_here], np.where(single[piece_here], rows[unit[piece_here], end - 1], ids[piece_here])
        if model.unigram:
            gain = best[u, s] + np.where(i < len(model.pieces), model.scores[np.minimum(i, len(model.pieces) - 1)], model.lowest)
        else:
            ok = model._is_made(i)
            u, s, i = u[ok], s[ok], i[ok]
            gain = np.zeros(len(u))
            inner = np.flatnonzero(s > 0)
            gain[inner[~model.are_apart(piece[u[inner], s[inner]], i[inner])]] = -np.inf
        gains = np.full((n, min(end, model.longest)), -np.inf)
        gains[u, end - 1 - s] = gain
        at = gains.argmax(1)
        chosen = np.flatnonzero(at[u] == end - 1 - s)
        best[:, end], back[:, end] = gains[r, at], end - 1 - at
        piece[u[chosen], end] = i[chosen]
        live = np.flatnonzero((ids != -1) & (end - start < model.longest))
        unit, start, h = unit[live], start[live], h[live]
    return piece, back


def _paths(piece: np.ndarray, back: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Pieces by their last position, from each unit's end back, all paths at once; -1 elsewhere."""
    n, width = piece.shape[0], piece.shape[1] - 1
    out, r, at = np.full((n, width), -1, np.int64), np.arange(n), widths.copy()
    while (on := at > 0).any():
        out[r[on], at[on] - 1] = piece[r[on], at[on]]
        at = np.where(on, back[r, at], 0)
    return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _lanes(model: Pieces, flat: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ends at each place of the given stretches of `flat`, and its length; rows padded with blanks."""
    width = int((end - begin).max())
    ends, sizes = np.zeros((len(begin), width), np.int32), np.zeros((len(begin), width), np.int16)
    step = max(1, BLOCK_CELLS // width)
    for i in range(0, len(begin), step):
        at = begin[i : i + step, None] + np.arange(width)
        points = np.where(at < end[i : i + step, None], flat[np.minimum(at, len(flat) - 1)], np.uint32(ord(MARK)))
        piece, back = _viterbi(model, points)
        ends[i : i + step], sizes[i : i + step] = piece[:, 1:], (np.arange(width + 1) - back)[:, 1:]
    return ends, sizes


def _joined(model: Pieces, ends: np.ndarray, sizes: np.ndarray, lane: int, length: int) -> list[int] | None:
    """The path of one unit from its lanes, or None if two of them don't come to agree."""
    n, width = ends.shape
    low, high = np.zeros(n, np.int64), np.full(n, length - (n - 1) * lane)
    if n > 1:
        over = width - lane
        differ = np.cumsum(np.pad(ends[:-1, lane:] != ends[1:, :over], ((0, 0), (1, 0))), axis=1)
        agreed = differ[:, model.longest :] == differ[:, : -model.longest]
        if not agreed.any(1).all():
            return None
        low[1:] = agreed.argmax(1) + model.longest
        high[:-1] = lane + low[1:]
    column = np.arange(width)
    mine = (column >= low[:, None]) & (column < high[:, None])
    ends, sizes = ends[mine], sizes[mine]
    out, at = [], length
    while at > 0:  # a stretch at a time, so that lists stay short
        first = max(0, at - (1 << 20))
        piece, size = ends[first:at].tolist(), sizes[first:at].tolist()
        while at > first:
            out.append(piece[at - first - 1])
            at -= size[at - first - 1]
    return out[::-1]


def _long_units(model: Pieces, units: list[str]) -> list[list[int]]:
    """The symbols of long units' paths; the lanes of all units advance together."""
    found: list[list[int] | None] = [None] * len(units)
    todo, lane, over = list(range(len(units))), LANE, OVERLAP * model.longest
    points = [_points(MARK + u) for u in units]
    while todo:
        stop = np.cumsum([len(points[i]) for i in todo])
        starts = [np.arange(0, max(1, len(points[i]) - over), lane) for i in todo]
        flat, count = np.concatenate([points[i] for i in todo]), np.array([len(x) for x in starts])
        begin = np.concatenate([x + z - len(points[i]) for x, z, i in zip(starts, stop, todo)])
        ends, sizes = _lanes(model, flat, begin, np.minimum(begin + lane + over, np.repeat(stop, count)))
        rows = np.concatenate(([0], np.cumsum(count)))
        for i, a, b in zip(todo, rows, rows[1:]):
            found[i] = _joined(model, ends[a:b], sizes[a:b], lane, len(points[i]))
        todo, lane = [i for i in todo if found[i] is None], lane * 4
    return found


def encode_units(model: Pieces, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of units, end to end, how many each has, and the order of the units in which they come.

    Equal lengths advance together; few units of a length with those up to a quarter longer. A unit stands
    without its first blank.
    """
    lengths = np.fromiter(map(len, units), np.int64, len(units)) + 1
    order = np.argsort(lengths, kind="stable")
    lengths = lengths[order]
    flat, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at, short = 0, len(order) if model.unigram else int(np.searchsorted(lengths, LANE, "right"))
    while at < short:
        width = int(lengths[at])
        stop = int(np.searchsorted(lengths, width, "right"))
        if stop - at <= FEW_UNITS:
            stop = int(np.searchsorted(lengths, width + width // 4 + 2, "right"))
        stop = min(stop, short, at + max(1, min(BLOCK_UNITS, BLOCK_CELLS // width)))
        width = int(lengths[stop - 1])
        part = "".join([(MARK + units[i]).ljust(width, MARK) for i in order[at:stop]])
        done = _paths(*_viterbi(model, _points(part).reshape(stop - at, width)), lengths[at:stop])
        kept = done >= 0
        ids, n = model.spelled(done[kept], kept.sum(1))
        flat.append(ids)
        sizes.append(n)
        at = stop
    if short < len(order):
        paths = _long_units(model, [units[i] for i in order[short:]])
        ids, n = model.spelled(np.fromiter(chain.from_iterable(paths), np.int64), np.array([len(x) for x in paths], np.int64))
        flat.append(ids)
        sizes.append(n)
    return np.concatenate(flat), np.concatenate(sizes), order


class Encoder:
    """Encodes texts; keeps the ids of the units it has met, up to a number of units and of ids."""

    def __init__(self, model: Pieces, kept_units: int = 500_000, kept_ids: int = 1 << 22):
        self.model, self.kept_units, self.kept_ids = model, kept_units, kept_ids
        self._clear()

    def _clear(self) -> None:
        self.where: dict[str, int] = {}
        self.flat, self.begin = np.zeros(0, np.int32), np.zeros(1, np.int64)

    @staticmethod
    def units(text: str) -> list[str]:
        """The text's units, each without its first blank; the text gets a blank in front."""
        if not text:
            return []
        cut = text.split(" ")
        # without leading, doubled or trailing blanks these are the units
        return cut if MARK not in text and "" not in cut else [u[1:] for u in UNITS.findall(MARK + text.replace(" ", MARK))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one more at the end)."""
        cut = [self.units(t) for t in texts]
        new = set().union(*cut).difference(self.where)
        if self.where and (len(self.where) + len(new) > self.kept_units or len(self.flat) > self.kept_ids):
            self._clear()
            new = set().union(*cut)
        if new:
            units = list(new)
            ids, sizes, order = encode_units(self.model, units)
            self.where.update(zip([units[i] for i in order], range(len(self.where), len(self.where) + len(units))))
            self.flat = np.concatenate((self.flat, ids.astype(np.int32)))
            self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(sizes)))
        counts = [len(c) for c in cut]
        at = np.fromiter(map(self.where.__getitem__, chain.from_iterable(cut)), np.int64, sum(counts))
        sizes = self.begin[at + 1] - self.begin[at]
        stop = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.flat[np.repeat(self.begin[at] - stop[:-1], sizes) + np.arange(stop[-1])]
        return ids, stop[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]


def decode_all(model: Pieces, ids: np.ndarray, begin: np.ndarray, tables=None) -> list[str]:
    """Texts of the ids: the pieces' bytes end to end, marks as blanks, less the dummy prefix."""
    flat, at = tables or decoding_tables(model)
    sizes = at[ids + 1] - at[ids]
    stop = np.concatenate(([0], np.cumsum(sizes)))
    data = flat[np.repeat(at[ids] - stop[:-1], sizes) + np.arange(stop[-1])].tobytes()
    cut = stop[begin]
    texts = [data[a:b].decode("utf-8", "replace").replace(MARK, " ") for a, b in zip(cut, cut[1:])]
    return [t[1:] if t[:1] == " " else t for t in texts]


def decoding_tables(model: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces end to end, and where each one's begin."""
    spell = [bytes([int(p[3:5], 16)]) if k == "byte" else p.encode() if k == "normal" else b"" for p, k in zip(model.pieces, model.kinds)]
    return np.frombuffer(b"".join(spell), np.uint8), np.concatenate(([0], np.cumsum([len(s) for s in spell])))


def _pieces_of_texts(texts: list[str], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def _encode(batches: Iterator[pa.RecordBatch], model_file: str) -> Iterator[pa.RecordBatch]:
    """Columns: the row and its text. Gives the row, ids and whether they decode to the text."""
    model = Pieces.load(model_file)
    encoder, tables = Encoder(model), decoding_tables(model)
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for i, j in _pieces_of_texts(texts):
            ids, begin = encoder.encode(texts[i:j])
            back = decode_all(model, ids, begin, tables)
            same = [x == y for x, y in zip(back, texts[i:j])]
            lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), lists, pa.array(same)], names=["row", "ids", "same"])


def encoded(docs: DataFrame, keep: list[str], model_file: str = DEFAULT_MODEL) -> DataFrame:
    """row (a struct of the `keep` columns), ids (array<int>) and same (the ids decode to the text)."""
    bounded_batches(docs.sparkSession)
    rows = carried(docs, keep)
    schema = StructType().add(rows.schema["row"]).add("ids", ArrayType(IntegerType())).add("same", BooleanType())
    return rows.mapInArrow(partial(_encode, model_file=model_file), schema)


def _decode(batches: Iterator[pa.RecordBatch], model_file: str) -> Iterator[pa.RecordBatch]:
    """Columns: the row and its ids. Gives the row and the text."""
    model = Pieces.load(model_file)
    tables = decoding_tables(model)
    for batch in batches:
        lists = [x or [] for x in batch.column(1).to_pylist()]
        begin = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
        texts = decode_all(model, np.fromiter(chain.from_iterable(lists), np.int64, int(begin[-1])), begin, tables)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])


def decoded(rows: DataFrame, ids: str, keep: list[str], model_file: str = DEFAULT_MODEL) -> DataFrame:
    """row (a struct of the `keep` columns) and text, what the column `ids` decodes to."""
    rows = rows.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in keep]).alias("row"), F.col(f"`{ids}`").cast("array<int>").alias("ids"))
    schema = StructType().add(rows.schema["row"]).add("text", StringType())
    return rows.mapInArrow(partial(_decode, model_file=model_file), schema)


def token_ids(docs: DataFrame, model_file: str = DEFAULT_MODEL) -> DataFrame:
    """A row per document: doc_id, n_tokens, ids, round_trip."""
    rows = encoded(docs, ["doc_id"], model_file)
    return unpacked(rows, ["doc_id"], F.size("ids").cast("long").alias("n_tokens"), F.col("ids"), F.col("same").alias("round_trip"))
