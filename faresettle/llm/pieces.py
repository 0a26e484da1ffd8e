"""SentencePiece segmentation: the n best paths through the piece lattice, and decoding."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faresettle.llm.utf8 import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 3
# How SentencePiece writes a space in a piece (fixed value).
SPACE = "▁"
# A character without a piece costs this much more than the worst piece, and is written as its bytes.
UNKNOWN_PENALTY = 10.0
# Texts that are taken apart together, segments whose paths a worker remembers (half of them are forgotten beyond), segments solved together.
SLICE_BYTES = 2 << 20
REMEMBERED = 350_000
SOLVED_CELLS = 1 << 20
# Longer segments are searched alone, in stretches of the lattice of so many characters.
LONG = 1 << 15
STRETCH = 1 << 14
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_PAD = np.uint64(1 << 40)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their ids and scores; `bytes_of` says what an id decodes to, `byte_ids` the 256 byte pieces."""

    pieces: dict[str, int]
    scores: dict[str, float]
    bytes_of: list[bytes]
    byte_ids: list[int]

    @staticmethod
    def load(path: str | Path) -> Vocabulary:
        """Of a model file with byte pieces, on the driver; it is bounded by the model and travels with the tasks."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=str(path))
        pieces, scores, bytes_of, byte_ids = {}, {}, [], [-1] * 256
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                value = int(piece[1:-1], 16)
                byte_ids[value] = k
                bytes_of.append(bytes([value]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                bytes_of.append(b"")
            else:
                plain = piece.replace(SPACE, " ")
                pieces[plain], scores[plain] = k, model.get_score(k)
                bytes_of.append(plain.encode())
        if min(byte_ids) < 0:
            raise ValueError("the model has no piece for every byte")
        return Vocabulary(pieces, scores, bytes_of, byte_ids)

    def decode(self, ids: list[int]) -> str:
        """The text that was encoded; the space put ahead of it goes."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


@dataclass
class Paths:
    """The best paths of one text, best first: ids and scores."""

    ids: list[np.ndarray]
    scores: list[float]


class _Known:
    """The best paths of the segments met so far, by the segment's number: where their ids lie, and their scores.

    Segments are named by their UTF-8. The ids of a segment's paths lie one path after the other. `met` counts the slices of text
    that hold a segment, `last` is the last of them.
    """

    def __init__(self, n_best: int) -> None:
        self.number: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = self.slice = 0
        self.begin = np.zeros(1 << 12, np.int64)
        self.size = np.zeros((1 << 12, n_best), np.int32)
        self.score = np.zeros((1 << 12, n_best))
        self.met = np.zeros(1 << 12, np.int32)
        self.last = np.zeros(1 << 12, np.int32)

    def reserve(self, segments: int) -> None:
        if len(self.begin) >= segments:
            return
        for name in ("begin", "size", "score", "met", "last"):
            old = getattr(self, name)
            new = np.zeros((segments * 3 // 2, *old.shape[1:]), old.dtype)
            new[: len(old)] = old
            setattr(self, name, new)

    def keep(self, rows: np.ndarray, ids: np.ndarray, sizes: np.ndarray, scores: np.ndarray) -> None:
        """Paths of the segments in `rows`, all ids one after the other."""
        if len(self.ids) < self.used + len(ids):
            more = np.zeros((self.used + len(ids)) * 3 // 2, np.int32)
            more[: self.used] = self.ids[: self.used]
            self.ids = more
        self.ids[self.used : self.used + len(ids)] = ids
        whole = sizes.sum(1)
        self.begin[rows] = self.used + np.cumsum(whole) - whole
        self.size[rows], self.score[rows] = sizes, scores
        self.met[rows] = 0
        self.used += len(ids)

    def meet(self, rows: np.ndarray) -> None:
        """The segments that a slice of text holds."""
        self.slice += 1
        self.met[rows] += 1
        self.last[rows] = self.slice

    def forget(self, most: int) -> None:
        """All but `most` segments: those met in most slices stay, of these those met last; earlier meetings count half."""
        count = len(self.number)
        most = min(most, count)
        worth = self.met[:count].astype(np.int64) << 32 | self.last[:count]
        rows = np.sort(np.argpartition(worth, count - most)[count - most :]) if most else np.zeros(0, np.int64)
        stays = np.zeros(count, bool)
        stays[rows] = True
        # Numbers follow the order in which the segments were learnt.
        self.number = {name: k for k, name in enumerate(name for name, stay in zip(self.number, stays.tolist()) if stay)}
        whole, begin = self.size[rows].sum(1), self.begin[rows]
        ends = np.cumsum(whole)
        self.used = int(ends[-1]) if most else 0
        self.ids = self.ids[np.repeat(begin - ends + whole, whole) + np.arange(self.used)]
        self.begin, self.size, self.score, self.met, self.last = ends - whole, self.size[rows], self.score[rows], self.met[rows] // 2, self.last[rows]

    def path(self, segment: int, rank: int) -> np.ndarray:
        begin = self.begin[segment] + self.size[segment, :rank].sum()
        return self.ids[begin : begin + self.size[segment, rank]]


@dataclass
class Segmenter:
    """N-best segmentation of texts.

    A text, with a space ahead, is cut where no piece can lie across: before runs of spaces and around line ends.
    So its lattice is a chain of the lattices of its segments, its n best paths are combinations of theirs, and a
    segment that occurs again is not searched again.
    """

    vocabulary: Vocabulary
    n_best: int = N_BEST

    def __post_init__(self) -> None:
        self.known = _Known(self.n_best)
        names = list(self.vocabulary.pieces)
        self.longest = max(map(len, names), default=1)
        self.whole = any(" " in p.lstrip(" ") or "\n" in p for p in names)
        self.spelled = pa.array(self.vocabulary.bytes_of, pa.large_binary())
        top = max(4096, self.longest + 1)
        self.power = self._powers(_MULTIPLIER, top)
        self.inverse = self._powers(pow(_MULTIPLIER, -1, 1 << 64), top)
        starts = list(dict.fromkeys(p[:k] for p in names for k in range(1, len(p) + 1)))
        hashes = np.array([self._hash(p) for p in starts], np.uint64)
        self.hashes = hashes
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two beginnings of pieces share a hash")
        # Of the beginnings that are no pieces, the ids are -1.
        self.ids = np.array([self.vocabulary.pieces.get(p, -1) for p in starts], np.int32)
        self.scores = np.array([self.vocabulary.scores.get(p, -np.inf) for p in starts], np.float64)
        # Where a hash's leading bits point to; beginnings that find their place taken are few and searched apart.
        self.table = np.full(1 << 20, -1, np.int32)
        lead = (hashes >> np.uint64(44)).astype(np.int64)
        self.table[lead[::-1]] = np.arange(len(hashes), dtype=np.int32)[::-1]
        self.crowded = np.flatnonzero(self.table[lead] != np.arange(len(hashes)))
        self.shared = np.zeros(1 << 20, bool)
        self.shared[lead[self.crowded]] = True
        self.crowded = self.crowded[np.argsort(hashes[self.crowded])]
        scores = np.array([self.vocabulary.scores[p] for p in names], np.float64)
        self.unknown = float(scores.min(initial=0.0)) - UNKNOWN_PENALTY
        ordinary = scores[scores > -1e8]
        if len(ordinary):
            self.unknown = float(ordinary.min()) - UNKNOWN_PENALTY
        self.first_unknown = len(self.vocabulary.bytes_of)

    @staticmethod
    def _powers(base: int, count: int) -> np.ndarray:
        power = np.full(count, base, np.uint64)
        power[0] = 1
        return np.cumprod(power, dtype=np.uint64)

    def _hash(self, piece: str) -> int:
        return sum((ord(c) + 1) * pow(_MULTIPLIER, k, 1 << 64) for k, c in enumerate(piece)) * _MULTIPLIER % (1 << 64)

    def _lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash among the beginnings of pieces, or -1."""
        lead = (hashes >> np.uint64(44)).astype(np.int64)
        out = self.table[lead]
        if not len(self.hashes):
            return out
        wrong = self.hashes[out] != hashes
        out[wrong] = -1
        if len(self.crowded):
            again = np.nonzero(wrong & self.shared[lead])
            held = self.hashes[self.crowded]
            at = np.minimum(np.searchsorted(held, hashes[again]), len(held) - 1)
            out[again] = np.where(held[at] == hashes[again], self.crowded[at], -1)
        return out

    def solve(self, names: list[bytes]) -> None:
        """Learn the n best paths of new segments; those of like length are searched side by side."""
        known = self.known
        first = len(known.number)
        known.reserve(first + len(names))
        known.number.update(zip(names, range(first, first + len(names))))
        segments = [name.decode("utf-8", "surrogatepass") for name in names]
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        widths = np.where(lengths <= 16, lengths, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        for k in np.flatnonzero(lengths > LONG).tolist():
            known.keep(np.array([first + k]), *self._search_long(segments[k]))
        widths[lengths > LONG] = -1
        for width in np.unique(widths).tolist():
            if width < 0:
                continue
            members = np.flatnonzero(widths == width)
            most = max(1, SOLVED_CELLS // ((width + 1) * (min(width, self.longest) + 1)))
            for low in range(0, len(members), most):
                part = members[low : low + most]
                known.keep(first + part, *self._search([segments[k] for k in part.tolist()], width))

    def _edges(self, segments: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores and ids of the pieces that end at a position and have a length, (segment, position, length); lengths of segments."""
        sizes = np.array([len(s) for s in segments])
        codes = np.full((len(segments), width), _PAD)
        codes[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        if width >= len(self.power):
            self.power, self.inverse = (self._powers(b, width + 1) for b in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)))
        rolled = np.zeros((len(segments), width + 1), np.uint64)
        np.cumsum((codes + np.uint64(1)) * self.power[:width], axis=1, dtype=np.uint64, out=rolled[:, 1:])
        rolled = rolled.ravel()
        # Where pieces may still begin: only what begins as a piece does is looked up with a character more.
        inside = np.arange(width) < sizes[:, None]
        row, start = np.nonzero(inside)
        cell, left, back = row * (width + 1) + start, sizes[row] - start, self.inverse[start] * np.uint64(_MULTIPLIER)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for length in range(1, min(width, self.longest) + 1):
            if length > 1:
                more = left >= length
                cell, left, back = cell[more], left[more], back[more]
            at = self._lookup((rolled[cell + length] - rolled[cell]) * back)
            begins = at >= 0
            cell, left, back, at = cell[begins], left[begins], back[begins], at[begins]
            if not len(cell):
                break
            hit = self.ids[at] >= 0
            found.append((cell[hit] + length, at[hit]))
        # Lengths that no segment here has a piece of are left out.
        used = max([1, *(length for length, (cell, _) in enumerate(found, 1) if len(cell))])
        score = np.full((len(segments) * (width + 1), used + 1), -np.inf)
        piece = np.full(score.shape, -1, np.int32)
        for length, (cell, at) in enumerate(found[:used], 1):
            score[cell, length] = self.scores[at]
            piece[cell, length] = self.ids[at]
        score, piece = (x.reshape(len(segments), width + 1, used + 1) for x in (score, piece))
        alone = (piece[:, 1:, 1] < 0) & inside
        score[:, 1:, 1][alone] = self.unknown
        piece[:, 1:, 1][alone] = self.first_unknown + codes[alone].astype(np.int32)
        return score, piece, sizes

    def _search(self, segments: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward Viterbi scores, then A* from each segment's end to its beginning.

        The Viterbi score of a position is exactly what the rest of a backward path can still gain, so an
        entry of the agenda is worth what its best completion is worth, no two entries share a completion, and the `n_best`
        best entries are all that the agenda needs. Entries of equal worth keep their order: the better parent's
        first, shorter pieces first.
        """
        score, piece, sizes = self._edges(segments, width)
        count, reach, n = len(segments), score.shape[2] - 1, self.n_best
        ahead = np.full((count, width + 1), -np.inf)
        ahead[:, 0] = 0
        # What an entry at a position is worth, beside its own gain, if it goes on by a length; at the beginning it stays.
        via = np.full(score.shape, -np.inf)
        via[:, 0, 0] = 0
        for position in range(1, width + 1):
            back = min(position, reach)
            via[:, position, 1 : back + 1] = ahead[:, position - back : position][:, ::-1] + score[:, position, 1 : back + 1]
            ahead[:, position] = via[:, position].max(1)
        # By row of a segment and a position in it. An entry at the beginning stays there and gains nothing.
        rows, via, gain, piece = np.arange(count) * (width + 1), via.reshape(-1, reach + 1), score.ravel(), piece.ravel()
        gain[:: reach + 1] = 0
        place = np.zeros((count, n), np.int64)
        place[:, 0] = sizes
        gained = np.full((count, n), -np.inf)
        gained[:, 0] = 0
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        active = np.flatnonzero(sizes > 0)
        while len(active):
            at, got = place[active], gained[active]
            spot = at + rows[active, None]
            total = via.take(spot.ravel(), 0).reshape(len(active), n, reach + 1)
            total += got[:, :, None]
            total = total.reshape(len(active), -1)
            first = np.arange(len(active)) * total.shape[1]
            chosen = np.empty((len(active), n), np.int64)
            worth = np.empty((len(active), n))
            for k in range(n):
                chosen[:, k] = total.argmax(1)
                here = first + chosen[:, k]
                worth[:, k] = total.ravel().take(here)
                total.ravel()[here] = -np.inf
            # Where no entry is left, `chosen` is 0.
            parent, length = np.divmod(chosen, reach + 1)
            none = worth == -np.inf
            came = parent + (np.arange(len(active)) * n)[:, None]
            edge = spot.ravel().take(came) * (reach + 1) + length
            now, gains = at.ravel().take(came) - length, got.ravel().take(came) + gain.take(edge)
            now[none], gains[none] = 0, -np.inf
            place[active], gained[active] = now, gains
            steps.append((active, parent, piece.take(edge)))
            active = active[(now > 0).any(1)]
        ids, path_sizes = self._paths(count, steps)
        return ids, path_sizes, gained

    def _stretch(self, segment: str, number: int) -> np.ndarray:
        """Scores of the pieces that end in a stretch, (position, length); the first row is that of the stretch's second position."""
        low = number * STRETCH
        begin, high = max(0, low - self.longest), min(len(segment), low + STRETCH)
        return self._edges([segment[begin:high]], high - begin)[0][0][low - begin + 1 :]

    def _search_long(self, segment: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As `_search`, for one segment of any length.

        Only the Viterbi scores are kept for all positions. Edges are made anew by stretches, of which the agenda's entries need
        the few that they are in, and each step keeps three bytes an entry: which entry it came from and how long its piece is.
        """
        n, length = self.n_best, len(segment)
        ahead = np.full(length + 1, -np.inf)
        ahead[0] = 0
        for number in range(-(-length // STRETCH)):
            rows = self._stretch(segment, number)
            reach, low = rows.shape[1] - 1, number * STRETCH + 1
            for at, row in enumerate(rows, low):
                back = min(at, reach)
                ahead[at] = (ahead[at - back : at][::-1] + row[1 : back + 1]).max()
        held: dict[int, np.ndarray] = {}

        def ways(at: int) -> list[tuple[int, float]]:
            number = (at - 1) // STRETCH
            if number not in held:
                if len(held) > n:
                    del held[max(held)]
                held[number] = self._stretch(segment, number)
            row = held[number][at - 1 - number * STRETCH]
            return [(size, row[size]) for size in np.flatnonzero(row > -np.inf).tolist() if size <= at]

        place, gained = [length] + [0] * (n - 1), [0.0] + [-np.inf] * (n - 1)
        parents, sizes = bytearray(), array("H")
        while any(place):
            agenda = []
            for k in range(n):
                if gained[k] == -np.inf:
                    continue
                if not place[k]:
                    agenda.append((gained[k], k, 0, 0.0))
                else:
                    agenda += [(gained[k] + (ahead[place[k] - size] + score), k, size, score) for size, score in ways(place[k])]
            # The sort keeps the order of equal ones: the better parent's first, shorter pieces first.
            best = sorted(agenda, key=lambda x: -x[0])[:n]
            none = n - len(best)
            place = [place[k] - size for _, k, size, _ in best] + [0] * none
            gained = [gained[k] + score for _, k, _, score in best] + [-np.inf] * none
            parents += bytes(k for _, k, _, _ in best) + bytes(none)
            sizes.extend([size for _, _, size, _ in best] + [0] * none)
        paths = [self._follow(segment, parents, sizes, k) if gained[k] > -np.inf else [] for k in range(n)]
        return np.array([x for path in paths for x in path], np.int32), np.array([[len(path) for path in paths]]), np.array([gained])

    def _follow(self, segment: str, parents: bytearray, sizes: array, entry: int) -> list[int]:
        """The ids of a path; steps ran from the segment's end, so the last one tells its first piece."""
        n, at, out = self.n_best, 0, []
        for step in range(len(parents) - n, -1, -n):
            size = sizes[step + entry]
            if size:
                piece = segment[at : at + size]
                at += size
                known = self.vocabulary.pieces.get(piece)
                out += self._bytes(self.first_unknown + ord(piece)) if known is None else [known]
            entry = parents[step + entry]
        return out

    def _paths(self, count: int, steps: list) -> tuple[np.ndarray, np.ndarray]:
        """Follow each path back through the steps; they ran from the end, so pieces come in reading order."""
        n = self.n_best
        entry = np.tile(np.arange(n), (count, 1))
        trail = np.full((count, n, max(1, len(steps))), -1, np.int32)
        for k, (active, parent, taken) in enumerate(reversed(steps)):
            here = entry[active]
            trail[active, :, k] = np.take_along_axis(taken, here, 1)
            entry[active] = np.take_along_axis(parent, here, 1)
        flat = trail.reshape(count * n, -1)
        used = flat >= 0
        sizes, ids = used.sum(1), flat[used]
        if (unknown := ids >= self.first_unknown).any():
            spelled = {c: self._bytes(c) for c in np.unique(ids[unknown]).tolist()}
            widths = np.ones(len(ids), np.int64)
            widths[unknown] = [len(spelled[c]) for c in ids[unknown].tolist()]
            sizes = np.bincount(np.repeat(np.arange(count * n), sizes), weights=widths, minlength=count * n).astype(np.int64)
            letters = [b for c in ids[unknown].tolist() for b in spelled[c]]
            ids = np.repeat(ids, widths)
            ids[np.repeat(unknown, widths)] = letters
        return ids, sizes.reshape(count, n)

    def _bytes(self, code: int) -> list[int]:
        return [self.vocabulary.byte_ids[b] for b in chr(code - self.first_unknown).encode("utf-8", "surrogatepass")]

    def _cut(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct segments of texts, which of them each segment is, and where each text's segments begin and the last one's end."""
        joined = b"".join(texts)
        data = np.frombuffer(joined, np.uint8)
        bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))))
        first = np.zeros(len(data) + 1, bool)
        first[bounds] = True
        if not self.whole and len(data):
            space, line = data == 0x20, data == 0x0A
            first[:-1] |= line
            first[1:] |= line
            first[1:-1] |= space[1:] & ~space[:-1]
        begin = np.flatnonzero(first)
        parts = pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(begin), pa.py_buffer(joined)]).dictionary_encode()
        _, offsets, held = parts.dictionary.buffers()
        ends = np.frombuffer(offsets, np.int64)[: len(parts.dictionary) + 1].tolist()
        held = held.to_pybytes() if held is not None else b""
        return [held[low:high] for low, high in zip(ends, ends[1:])], parts.indices.to_numpy(), np.searchsorted(begin, bounds)

    def encode(self, texts: list[str]) -> Iterator[tuple[Paths, bool]]:
        """The n best segmentations of each text, best first, and whether all decode to it; the empty text has one, without pieces."""
        spaced = [f" {text}".encode("utf-8", "surrogatepass") if text else b"" for text in texts]
        if len(self.known.number) > REMEMBERED:
            self.known.forget(REMEMBERED // 2)
        known = self.known
        names, which, bounds = self._cut(spaced)
        self.solve([name for name in names if name not in known.number])
        numbers = np.fromiter(map(known.number.__getitem__, names), np.int64, len(names))
        known.meet(numbers)
        segment = numbers[which]
        size, begin = known.size[segment, 0].astype(np.int64), known.begin[segment]
        ends = np.cumsum(size)
        best = known.ids[np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        starts = np.concatenate(([0], ends))
        score = known.score[segment]
        every = [
            self._combine(segment[low:high], score[low:high], best[starts[low] : starts[high]], starts[low : high + 1] - starts[low])
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist())
        ]
        return zip(every, self._decoded(texts, every))

    def _decoded(self, texts: list[str], every: list[Paths]) -> list[bool]:
        """Whether all paths of each text decode to it, as by `Vocabulary.decode`; the bytes of all paths are written at once."""
        ids = [path for paths in every for path in paths.ids]
        if not ids:
            return []
        written = self.spelled.take(pa.array(np.concatenate(ids)))
        _, offsets, data = written.buffers()
        data = memoryview(data if data is not None else b"")
        ends = np.frombuffer(offsets, np.int64)[np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))].tolist()
        out, low, k = [], 0, 0
        for text, paths in zip(texts, every):
            same = True
            for _ in paths.ids:
                same &= str(data[low : ends[k]], "utf-8", "replace").removeprefix(" ") == text
                low, k = ends[k], k + 1
            out.append(same)
        return out

    def _combine(self, segments: np.ndarray, score: np.ndarray, best: np.ndarray, begin: np.ndarray) -> Paths:
        """The best combinations of segments' paths.

        One of the n best differs from the best in n - 1 segments at most, and these are among the n - 1 segments
        whose second paths lose least; earlier segments go first among equal ones.
        """
        n = self.n_best
        if not len(segments):
            return Paths([best], [0.0])
        combined: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        loss = score[:, 0] - score[:, 1] if n > 1 else np.zeros(0)
        for _ in range(min(n - 1, len(loss))):
            k = int(loss.argmin())
            if loss[k] == np.inf:
                break
            loss[k] = np.inf
            lost = [(j, float(score[k, 0] - score[k, j])) for j in range(n) if score[k, j] > -np.inf]
            ways = [(more + old, (*way, (k, j)) if j else way) for old, way in combined for j, more in lost]
            combined = sorted(ways, key=lambda x: x[0])[:n]
        total = float(score[:, 0].sum())
        ids = []
        for _, way in combined:
            at, parts = 0, []
            for k, j in sorted(way):
                parts += [best[at : begin[k]], self.known.path(segments[k], j)]
                at = begin[k + 1]
            ids.append(np.concatenate([*parts, best[at:]]) if way else best)
        return Paths(ids, [total - lost for lost, _ in combined])


ENCODED = "doc_id long, ids array<int>, n_pieces long, score double, scores array<double>, digests array<long>, decoded boolean, segmentations array<array<int>>"
_SEGMENTERS: dict[tuple[str, int], Segmenter] = {}


def _segmenter(held, key: tuple[str, int]) -> Segmenter:
    """The worker's own segmenter; what it remembers only saves time."""
    if key not in _SEGMENTERS:
        _SEGMENTERS[key] = Segmenter(held.value, key[1])
    return _SEGMENTERS[key]


def _nested(sizes: list[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values)


def _lists(paths: list[np.ndarray]) -> pa.ListArray:
    return _nested([len(path) for path in paths], pa.array(np.concatenate(paths), pa.int32()))


def encode_documents(documents: DataFrame, model: str = MODEL, n_best: int = N_BEST) -> DataFrame:
    """`ENCODED` per row of `documents`: the best ids, how many, all n scores and checksums (CRC-32 of the ids as
    little-endian int32), whether each of the n segmentations decodes to the text, and the ids of all n, best first.

    A null or empty text has one segmentation, without pieces, of score 0. Null ids stay null, repeated rows come out
    repeated, other columns are ignored, an empty table gives no rows. No shuffle; a task holds a few MB of text or one row, and some bytes a character of
    a text without spaces or line ends.
    """
    held = documents.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    key = (str(model), n_best)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = _segmenter(held, key)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows = [
                    (paths.ids, paths.scores, [zlib.crc32(i.astype("<i4", copy=False)) for i in paths.ids], decoded)
                    for paths, decoded in segmenter.encode(texts)
                ]
                sizes = np.array([len(r[0][0]) for r in rows], np.int64)
                ids = _lists([r[0][0] for r in rows])
                segmentations = _nested([len(r[0]) for r in rows], _lists([path for r in rows for path in r[0]]))
                columns = [
                    part.column(0), ids, pa.array(sizes), pa.array([r[1][0] for r in rows], pa.float64()),
                    pa.array([r[1] for r in rows], pa.list_(pa.float64())), pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[3] for r in rows], pa.bool_()), segmentations,
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_pieces", "score", "scores", "digests", "decoded", "segmentations"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, ENCODED)


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """`doc_id`, `text` of rows with `doc_id`, `ids`; null ids give a null text."""
    held = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else held.value.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
