"""Sampled segmentation into the pieces of a SentencePiece model, and lossless decoding.

A text gets one leading space, as the model's own encoder adds, and is cut into units: a run of
spaces with the word behind it, or one line end.  No piece crosses a unit's edge, so the lattice of
a text is a chain of the lattices of its units.  Each distinct unit of a batch is filtered forward
once; each occurrence is then sampled backward with random numbers of its own.  Forward and
backward steps run over all units or occurrences at once.

The model holds merge ranks, not probabilities; a piece of rank r gets the weight
``(r + 2.7) ** -ALPHA`` times a constant (Zipf's law with Mandelbrot's shift).  A character
without a piece, and a literal U+2581, is the byte pieces of its UTF-8 form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundsheet.llm.texts import filled, slices, split_parts

#: Text bytes worked on at a time: a lattice takes a few hundred bytes for each byte of distinct units.
BATCH_BYTES = 768 << 10
#: Exponent of the weights; larger values draw the likeliest segmentation more often.
ALPHA = 1.2
SPACE = "▁"
_MULTIPLIER, _START = np.uint64(0x100000001B3), np.uint64(0xCBF29CE484222325)
_MODELS: dict[tuple[str, float], PieceLattice] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half the output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each begins."""
    joined = pc.binary_join(pa.array([texts.to_pylist()], pa.list_(pa.string())), "")[0].as_py() if len(texts) else ""
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64), np.concatenate([[0], np.cumsum(lengths)])


class PieceLattice:
    """The pieces of a model with their weights."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        kinds = [model.is_unknown(k) or model.is_control(k) or model.is_unused(k) for k in range(size)]
        is_byte = [model.is_byte(k) for k in range(size)]
        self.bytes = np.full(256, -1, np.int64)
        surface: list[bytes] = []
        texts = {}
        for k in range(size):
            piece = model.id_to_piece(k)
            if is_byte[k]:
                value = int(piece[3:5], 16)
                self.bytes[value] = k
                surface.append(bytes([value]))
            else:
                text = "" if kinds[k] else piece.replace(SPACE, " ")
                surface.append(text.encode())
                if text:
                    texts.setdefault(text, k)
        if (self.bytes < 0).any():
            raise ValueError("the model has no byte pieces")
        self.surface = np.array(surface, object)
        ids = np.array(list(texts.values()), np.int64)
        first = ids.min() if len(ids) else 0
        rank = (ids - first).astype(float)
        logs = -alpha * np.log(rank + 2.7)
        logs -= np.log(np.exp(logs).sum())
        self.unseen = float(logs.min()) - 2.0 if len(logs) else -10.0
        by_length: dict[int, list[int]] = {}
        listed = list(texts)
        for n, text in enumerate(listed):
            by_length.setdefault(len(text), []).append(n)
        self.tables = {}
        for length, members in sorted(by_length.items()):
            codes, _ = _codes(pa.array([listed[n] for n in members]))
            hashed = self._hash(codes.reshape(-1, length))
            order = np.argsort(hashed)
            if len(np.unique(hashed)) < len(hashed):
                raise ValueError("two pieces share a hash")
            seen = np.zeros(1 << 16, bool)  # most stretches of text are no piece: one look tells
            seen[hashed >> np.uint64(48)] = True
            spelled = codes.reshape(-1, length)[order]
            self.tables[length] = hashed[order], ids[members][order], logs[members][order], spelled, seen

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        value = np.full(len(codes), _START)
        for k in range(codes.shape[1]):
            value = (value ^ codes[:, k]) * _MULTIPLIER
        return value

    def edges(self, codes: np.ndarray, unit: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """start, end, log weight and id of every lattice edge; id -1 stands for byte pieces.

        ``unit`` is the unit of each code point, ``ends`` where the units end.
        """
        n = len(codes)
        room = ends[unit] - np.arange(n)
        found, value, single = [], np.full(n, _START), np.zeros(n, bool)
        for length in range(1, max(self.tables, default=0) + 1):
            live = np.flatnonzero(room >= length)
            if not len(live):
                break
            value[live] = (value[live] ^ codes[live + length - 1]) * _MULTIPLIER
            if length not in self.tables:
                continue
            keys, ids, logs, spelled, seen = self.tables[length]
            live = live[seen[value[live] >> np.uint64(48)]]
            at = np.minimum(np.searchsorted(keys, value[live]), len(keys) - 1)
            hit = keys[at] == value[live]
            start, at = live[hit], at[hit]
            same = np.ones(len(start), bool)
            for k in range(length):  # equal hashes are not yet equal pieces
                same &= codes[start + k] == spelled[at, k]
            start, at = start[same], at[same]
            found.append((start.astype(np.int32), (start + length).astype(np.int32), logs[at], ids[at].astype(np.int32)))
            if length == 1:
                single[start] = True
        bare = np.flatnonzero(~single)
        bare = bare.astype(np.int32)
        found.append((bare, bare + np.int32(1), np.full(len(bare), self.unseen), np.full(len(bare), -1, np.int32)))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def sample(self, units: pa.StringArray, occurrence: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every occurrence of a unit in order, and how many each has.

        ``occurrence`` holds unit numbers, ``keys`` a random 64-bit number for each occurrence.
        """
        codes, bounds = _codes(units)
        sizes = np.diff(bounds)
        unit = np.repeat(np.arange(len(units), dtype=np.int32), sizes)
        start, end, logs, ids = self.edges(codes, unit, bounds[1:])
        # A node is a place within a unit; nodes are numbered by distance from the unit's start, so all
        # edges into nodes of one distance stand together.
        owner = unit[start]
        begin = bounds.astype(np.int32)
        start, end = start - begin[owner], end - begin[owner]
        order = np.argsort(end * np.int64(len(units)) + owner, kind="stable")  # edges come by length, so starts follow
        start, end, logs, ids, owner = start[order], end[order], logs[order], ids[order], owner[order]
        fresh = np.ones(len(end), bool)
        fresh[1:] = (end[1:] != end[:-1]) | (owner[1:] != owner[:-1])
        node = np.cumsum(fresh, dtype=np.int32) - np.int32(1)  # of each edge's end; every place but the start is some edge's end
        number = np.full(int(bounds[-1]) + len(units), -1, np.int32)
        number[begin[owner] + owner + end] = node
        previous = number[begin[owner] + owner + start]
        heads = np.flatnonzero(fresh)
        forward = np.zeros(len(heads) + 1)  # the last one, reached by -1, is every unit's start
        chance = np.empty(len(end))
        steps = np.searchsorted(end, np.arange(1, int(sizes.max(initial=0)) + 2))
        for low, high in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
            if low == high:
                continue
            first, last = node[low], node[high - 1] + 1
            inside, at = heads[first:last] - low, node[low:high] - first
            value = forward[previous[low:high]] + logs[low:high]
            top = np.maximum.reduceat(value, inside)
            part = np.exp(value - top[at])
            total = np.add.reduceat(part, inside)
            forward[first:last] = top + np.log(total)
            chance[low:high] = part / total[at]
        upto = np.cumsum(chance)
        before = upto[heads] - chance[heads]
        upto = np.minimum(upto - before[node], 1.0) + node
        upto[np.append(heads[1:], len(end)) - 1] = np.arange(len(heads)) + 1.0  # the last edge takes what rounding leaves
        last_node = number[bounds[1:] + np.arange(len(units))]
        live, step, drawn = np.argsort(occurrence, kind="stable"), 0, []  # like units together, for the caches
        at = last_node[occurrence[live]]
        while len(live):
            random = _mix(keys[live] + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(11)
            edge = np.searchsorted(upto, at + random / float(1 << 53), side="right")
            drawn.append((live, edge))
            at = previous[edge]
            live, at, step = live[at >= 0], at[at >= 0], step + 1
        counts = np.zeros(len(occurrence), np.int64)
        for who, _ in drawn:
            counts[who] += 1
        stop = np.cumsum(counts)
        chosen = np.empty(int(stop[-1]) if len(stop) else 0, np.int64)
        for k, (who, edge) in enumerate(drawn):
            chosen[stop[who] - 1 - k] = edge
        found, per_edge = ids[chosen].astype(np.int64), np.ones(len(chosen), np.int64)
        if (bare := found < 0).any():
            found, per_edge = self._bytes(found, bare, codes[bounds[owner[chosen]] + start[chosen]])
            counts = np.bincount(np.repeat(np.arange(len(counts)), counts), weights=per_edge, minlength=len(counts)).astype(np.int64)
        return found, counts

    def _bytes(self, ids: np.ndarray, bare: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put the byte pieces of their characters in place of the bare edges."""
        per_edge = np.ones(len(ids), np.int64)
        points = codes[bare].astype(np.int64)
        per_edge[bare] = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        out = np.repeat(ids, per_edge)
        text = points.astype("<u4").tobytes().decode("utf-32-le").encode()
        out[np.repeat(bare, per_edge)] = self.bytes[np.frombuffer(text, np.uint8)]
        return out, per_edge

    def encode(self, texts: pa.Array, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all non-null texts in order, and how many each has; ``seeds`` holds one number per text."""
        rows, codes, units = _units(texts)
        if not len(rows):
            return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keys = _mix(seeds[rows] ^ _mix(place.astype(np.uint64) + np.uint64(1)))
        ids, counts = self.sample(units, codes, keys)
        return ids, np.bincount(rows, weights=counts, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the space that encoding put in front is taken off."""
        return b"".join(self.surface[ids]).decode()[1:]


def _units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
    """Text and distinct unit of every unit in order: cut before each run of spaces and around line ends.

    A text that is not empty gets its leading space here.
    """
    parts = [b" " + t.encode() if t else b"" for t in texts.to_pylist()]
    data, ends = b"".join(parts), np.cumsum([len(t) for t in parts])
    raw = np.frombuffer(data, np.uint8)
    cut, space, line = np.zeros(len(raw), bool), raw == 0x20, raw == 0x0A
    cut[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    begins = ends - [len(t) for t in parts]
    cut[begins[begins < ends]] = True
    starts = np.flatnonzero(cut)
    offsets = np.append(starts, len(raw)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    return np.searchsorted(ends, starts, side="right"), units.indices.to_numpy().astype(np.int64), units.dictionary


def lattice(path: str, alpha: float = ALPHA) -> PieceLattice:
    if (path, alpha) not in _MODELS:
        _MODELS[path, alpha] = PieceLattice(path, alpha)
    return _MODELS[path, alpha]


def seeds(keys: pa.Array, seed: int) -> np.ndarray:
    """One number per row key; null keys share one."""
    values = pc.fill_null(keys, 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return _mix(values + _mix(np.full(len(values), seed, np.uint64) + np.uint64(1)))


def encode_documents(documents: DataFrame, model: str, seed: int = 0, alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_ids, ids and lossless of every row of ``documents`` (doc_id, text).

    ``ids`` is a segmentation of the whole text drawn with the doc_id as key, so it comes out the
    same in every run and partitioning; another ``seed`` draws another.  ``lossless`` says that the
    ids decode to the text.  Null and empty texts have no ids; rows with a null doc_id share one
    key; repeated rows get the same ids; an empty table gives no rows.  Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(model, alpha)
        for batch in slices(batches, limit=BATCH_BYTES):
            texts = filled(batch)
            ids, counts = pieces.encode(texts, seeds(batch.column("doc_id"), seed))
            ends = np.cumsum(counts)
            back = [pieces.decode(ids[e - n : e]) == t for e, n, t in zip(ends, counts, texts.to_pylist(), strict=True)]
            offsets = pa.array(np.append(0, ends), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), pa.array(back)],
                ["doc_id", "n_ids", "ids", "lossless"],
            )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n_ids long, ids array<int>, lossless boolean")


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of every row of ``encoded`` (doc_id, ids); null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(model)
        for batch in batches:
            texts = [pieces.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
