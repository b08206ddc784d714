"""SentencePiece encoding with N-best segmentations, and decoding.

A text is a path through the lattice of vocabulary pieces; its score is the sum of piece scores.
No piece reaches across the start of a run of spaces or across a line break, so the lattice of a
text is a chain of small lattices, one per chunk, and the same chunks recur. All chunks of a batch
are matched against the piece trie and scored together: forward and backward Viterbi passes run in
lockstep over array positions, and give each chunk's best path and the score of the best path
that leaves it. Only the chunks whose next path costs least can enter a text's N best; in those a
backward A-star search, guided by the forward scores (the exact rest cost), lists paths in order
of score, and the lists are merged into the N best of the text.

Pieces are the model file's normal pieces with its scores; a character without a piece of its own
costs ten less than the lowest score and is written as its UTF-8 bytes. A space is the word mark;
one is put before every text and taken off in decoding, so decoding gives back every text.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass, field
from functools import cache, lru_cache
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MEMO = 60_000  # chunks a worker remembers,
WORTH = 100  # those of at most so many characters: longer ones hardly recur
BATCH_CHARS = 1 << 19
CHUNK = re.compile(r" +[^ \n]*|\n|[^ \n]+")
NO_PIECE = 0x110000  # codes from here on match nothing


class Vocabulary:
    """The pieces of a model file as a trie in hashed arrays."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(size)]
        normal = [
            i for i in range(size)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.score = np.array([model.get_score(i) for i in range(size)])
        self.unknown = float(self.score[normal].min()) - 10.0
        self.byte = {int(self.text[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.plain = [
            chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else t.replace(MARK, " ")
            for i, t in enumerate(self.text)
        ]
        self.part = np.zeros(size, bool)  # a byte of a longer character
        self.part[[i for i, b in self.byte_of.items() if b >= 128]] = True
        self.unknown_id = model.unk_id()
        self.ids = {self.text[i]: i for i in normal}
        self.longest = max(map(len, self.ids))
        crossing = re.compile(rf"[^{MARK}]{MARK}|\n.|.\n", re.S)
        if any(crossing.search(piece) for piece in self.ids):
            raise ValueError("a piece reaches across chunks")
        self._trie()

    def _trie(self) -> None:
        edges: dict[tuple[int, int], int] = {}
        ends = {}
        for piece, i in self.ids.items():
            node = 0
            for char in piece:
                node = edges.setdefault((node, ord(char)), len(edges) + 1)
            ends[node] = i
        self.piece = np.full(len(edges) + 1, -1)
        self.piece[list(ends)] = list(ends.values())
        self.bits = (len(edges) * 4).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.next = np.zeros(1 << self.bits, np.int64)
        self.probes = 1
        for (node, code), to in edges.items():
            key = node << 21 | code
            slot = int(self._slot(np.array([key]))[0])
            tries = 1
            while self.keys[slot] >= 0:
                slot, tries = (slot + 1) % len(self.keys), tries + 1
            self.keys[slot], self.next[slot] = key, to
            self.probes = max(self.probes, tries)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next trie node, 0 where there is none."""
        key = np.where(code < NO_PIECE, node << 21 | code, -2)
        slot = self._slot(key)
        found = np.where(self.keys[slot] == key, self.next[slot], 0)
        for _ in range(self.probes - 1):
            slot = (slot + 1) % len(self.keys)
            found = np.where((found == 0) & (self.keys[slot] == key), self.next[slot], found)
        return found

    def spelled(self, char: str) -> tuple[int, ...]:
        """A character without a piece: its bytes, or the unknown id if the model has none."""
        return tuple(self.byte.get(b, self.unknown_id) for b in char.encode("utf-8", "surrogatepass"))


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@dataclass
class Paths:
    """Best paths of chunks: their ids one after another, each path's length, its score, and by how
    much the chunk's next best path is lower."""

    ids: np.ndarray
    length: np.ndarray
    score: np.ndarray
    gap: np.ndarray

    def __add__(self, other: Paths) -> Paths:
        return Paths(*(np.concatenate((x, y)) for x, y in zip(self.__dict__.values(), other.__dict__.values())))


NO_PATHS = Paths(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))


def _edges(v: Vocabulary, codes: np.ndarray, end_of: np.ndarray):
    """All pieces in the text: where they start, their length and id; -1 spells a character."""
    start = np.arange(len(codes))
    node = np.zeros(len(codes), np.int64)
    single = np.zeros(len(codes), bool)
    starts, lengths, ids = [], [], []
    for n in range(1, v.longest + 1):
        inside = start + n <= end_of[start]
        start, node = start[inside], node[inside]
        node = v.step(node, codes[start + n - 1])
        start, node = start[node > 0], node[node > 0]
        if not len(start):
            break
        piece = v.piece[node]
        hit = piece >= 0
        if n == 1:
            single[start[hit]] = True
        starts.append(start[hit])
        lengths.append(np.full(int(hit.sum()), n))
        ids.append(piece[hit])
    alone = np.flatnonzero(~single)
    return (
        np.concatenate([alone, *starts]),
        np.concatenate([np.ones(len(alone), np.int64), *lengths]),
        np.concatenate([np.full(len(alone), -1), *ids]),
    )


def _by(relative: np.ndarray):
    """Indices grouped by a small integer, in rising order of it, each group in given order."""
    kind = np.uint16 if relative.max(initial=0) < 1 << 16 else np.int64
    order = np.argsort(relative.astype(kind), kind="stable")
    return np.split(order, np.flatnonzero(np.diff(relative[order])) + 1) if len(order) else []


def best_paths(v: Vocabulary, chunks: list[str]) -> Paths:
    """Best paths of many chunks at once."""
    if not chunks:
        return NO_PATHS
    codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    codes = np.where(codes == 32, ord(MARK), np.where(codes == ord(MARK), NO_PIECE, codes))
    size = np.fromiter(map(len, chunks), np.int64, len(chunks))
    chunk = np.repeat(np.arange(len(chunks)), size)
    ends = np.cumsum(size)
    start, length, ids = _edges(v, codes, ends[chunk])
    of = chunk[start]
    first = ends - size + np.arange(len(chunks))  # chunk k has size + 1 nodes from here on
    a = start + of
    b = a + length
    cost = np.where(ids >= 0, v.score[ids], v.unknown)
    nodes = len(codes) + len(chunks)

    ahead = np.full(nodes, -np.inf)
    ahead[first] = 0.0
    via = np.zeros(nodes, np.int64)
    for group in _by(b - first[of]):
        s = ahead[a[group]] + cost[group]
        np.maximum.at(ahead, b[group], s)
        top = group[s == ahead[b[group]]]
        via[b[top]] = top  # the last one, the longest piece, wins a tie
    back = np.full(nodes, -np.inf)
    back[first + size] = 0.0
    for group in _by((first + size)[of] - a):
        np.maximum.at(back, a[group], cost[group] + back[b[group]])

    on_path = np.zeros(len(a), bool)
    node, open_ = first + size, np.arange(len(chunks))
    taken = []
    while len(open_):
        edge = via[node]
        on_path[edge] = True
        taken.append(edge)
        node = a[edge]
        more = node > first[open_]
        node, open_ = node[more], open_[more]
    score = ahead[first + size]
    other = np.full(len(chunks), -np.inf)
    off = ~on_path
    np.maximum.at(other, of[off], (ahead[a] + cost + back[b])[off])
    gap = score - other

    path = np.concatenate(taken)
    path = path[np.argsort(a[path], kind="stable")]
    own, width = ids[path].astype(np.int32), np.ones(len(path), np.int64)
    spelled = {
        int(k): v.spelled(chunks[of[path[k]]][a[path[k]] - first[of[path[k]]]]) for k in np.flatnonzero(own < 0)
    }
    for k, several in spelled.items():
        width[k] = len(several)
    out = np.repeat(own, width)
    out[out < 0] = [x for k in sorted(spelled) for x in spelled[k]]
    length = np.bincount(of[path], weights=width, minlength=len(chunks)).astype(np.int64)
    return Paths(out, length, score, gap)


def n_best(v: Vocabulary, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best paths of one chunk by backward A-star; fewer if there are no more.

    Of paths that cost the same the one nearer to the start goes first, so that ties are followed in
    depth. A position is left at most ``n`` times: a later way from it to the end has ``n`` before it
    with the same beginnings. So the work and the memory are linear in the text.
    """
    marked = [MARK if c == " " else "" if c == MARK else c for c in text]
    into: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(len(text) + 1)]
    for i in range(len(text)):
        piece = ""
        for j in range(i, min(len(text), i + v.longest)):
            if not marked[j]:
                break
            piece += marked[j]
            if (k := v.ids.get(piece)) is not None:
                into[j + 1].append((i, float(v.score[k]), (k,)))
        if marked[i] not in v.ids:
            into[i + 1].append((i, v.unknown, v.spelled(text[i])))
    ahead = [0.0]
    for edges in into[1:]:
        ahead.append(max(ahead[i] + s for i, s, _ in edges))
    found: list[tuple[float, tuple[int, ...]]] = []
    agenda = [(-ahead[-1], len(text), 0, 0.0, None)]
    pushed = 0
    left = [0] * (len(text) + 1)
    while agenda and len(found) < n:
        _, at, _, done, path = heapq.heappop(agenda)
        if at == 0:
            ids = []
            while path:
                ids.extend(path[0])
                path = path[1]
            found.append((done, tuple(ids)))
            continue
        left[at] += 1
        if left[at] > n:
            continue
        for i, s, ids in into[at]:
            if left[i] < n:
                pushed += 1
                heapq.heappush(agenda, (-(ahead[i] + done + s), i, pushed, done + s, (ids, path)))
    return found


@lru_cache(MEMO // 4)
def _remembered(path: str, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
    return n_best(vocabulary(path), text, n)


def _alternatives(path: str, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
    return _remembered(path, text, n) if len(text) <= WORTH else n_best(vocabulary(path), text, n)


@dataclass
class Encoded:
    """A run of texts: ids one after another, each text's number of ids, score and other paths."""

    ids: np.ndarray
    length: np.ndarray
    score: np.ndarray
    others: list[list[tuple[float, list[tuple[int, int, list[int]]]]]]


@dataclass
class Encoder:
    """Encodes texts; remembers a bounded number of chunks."""

    path: str = MODEL
    n: int = 4
    memo: dict[str, int] = field(default_factory=dict)
    paths: Paths = field(default_factory=lambda: NO_PATHS)

    def encode(self, texts: list[str | None]):
        """Yields ``Encoded`` for runs of texts, in order. Other paths are (score, edits); an edit
        replaces ``length`` ids from ``start`` by others."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size < BATCH_CHARS):
                size += len(texts[end] or "")
                end += 1
            yield self._run(texts[at:end])
            at = end

    def _run(self, texts: list[str | None]) -> Encoded:
        split = [CHUNK.findall(" " + t) if t else [] for t in texts]
        chunks = list(chain.from_iterable(split))
        number = np.array([*map(self.memo.get, chunks, repeat(-1))], np.int64)
        unknown = np.flatnonzero(number < 0).tolist()
        fresh = dict.fromkeys(chunks[i] for i in unknown)
        short = [c for c in fresh if len(c) <= WORTH]
        new = {c: k for k, c in enumerate([*short, *(c for c in fresh if len(c) > WORTH)], len(self.memo))}
        number[unknown] = [new[chunks[i]] for i in unknown]
        paths = self.paths + best_paths(vocabulary(self.path), list(new))
        room = min(MEMO - len(self.memo), len(short))
        if room > 0:  # those beyond are found again when they recur
            self.memo |= dict(islice(new.items(), room))
            n = len(self.memo)
            self.paths = Paths(paths.ids[: paths.length[:n].sum()], paths.length[:n], paths.score[:n], paths.gap[:n])
        begin = np.cumsum(paths.length) - paths.length
        length = paths.length[number]
        ends = np.cumsum(length)
        ids = paths.ids[np.arange(length.sum()) + np.repeat(begin[number] - (ends - length), length)]
        cuts = np.cumsum([0, *map(len, split)])
        edges = np.concatenate(([0], ends))
        score, gap = paths.score[number], paths.gap[number]
        total, others = np.zeros(len(texts)), []
        for k in range(len(texts)):
            i, j = cuts[k], cuts[k + 1]
            total[k] = score[i:j].sum()
            others.append(self._others(total[k], gap[i:j], chunks, ids, edges, i))
        return Encoded(ids, np.diff(edges[cuts]), total, others)

    def _others(self, total: float, gap, chunks, ids, edges, first: int):
        most = self.n - 1
        loose = np.argpartition(gap, most - 1)[:most] if len(gap) > most > 0 else np.arange(len(gap) if most else 0)
        paths: list[tuple[float, tuple]] = [(0.0, ())]
        for k in sorted(loose[gap[loose] < np.inf].tolist()):
            own = ids[edges[first + k] : edges[first + k + 1]].tolist()
            ranked = _alternatives(self.path, chunks[first + k], self.n + 1)
            # The path already taken may tie with others: it comes first, the rest in order.
            options = [(0.0, None), *((ranked[0][0] - s, p) for s, p in ranked if list(p) != own)]
            joined = [
                (lost + more, edits if p is None else (*edits, (k, p)))
                for lost, edits in paths for more, p in options
            ]
            paths = heapq.nsmallest(self.n, joined, key=lambda x: x[0])
        return [
            (
                float(total - lost),
                [
                    (int(edges[first + k] - edges[first]), int(edges[first + k + 1] - edges[first + k]), list(p))
                    for k, p in edits
                ],
            )
            for lost, edits in paths[1:]
        ]


def edited(ids: list[int], edits) -> list[int]:
    """Another path's ids from the best path's and its edits."""
    out, at = [], 0
    for start, length, new in edits:
        out += ids[at:start]
        out += new
        at = start + length
    return out + ids[at:]


def spell_out(v: Vocabulary, ids: np.ndarray) -> str:
    """The marked text of ids, with the space in front; bytes that are no UTF-8 are replaced."""
    if not v.part[ids].any():
        return "".join(map(v.plain.__getitem__, ids.tolist()))
    parts: list[str] = []
    run = bytearray()
    for i in ids.tolist():
        if (byte := v.byte_of.get(i)) is not None:
            run.append(byte)
            continue
        if run:
            parts.append(run.decode("utf-8", "replace"))
            run.clear()
        parts.append(v.plain[i])
    parts.append(run.decode("utf-8", "replace"))
    return "".join(parts)


def decode(v: Vocabulary, ids) -> str:
    """The text of a sequence of ids."""
    return spell_out(v, np.asarray(ids, np.int64)).removeprefix(" ")


def decodes(v: Vocabulary, text: str | None, ids: np.ndarray, others) -> bool:
    """Whether the best path and, in what they replace, the other paths decode to the text."""
    return decode(v, ids) == (text or "") and all(
        spell_out(v, np.array(new)) == spell_out(v, ids[start : start + length])
        for _, edits in others for start, length, new in edits
    )


EDIT = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
])
OTHER = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("edits", T.ArrayType(EDIT))])
ENCODED = [
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("score", T.DoubleType()),
    T.StructField("others", T.ArrayType(OTHER)), T.StructField("round_trip", T.BooleanType()),
]


def encode(docs: DataFrame, path: str = MODEL, n: int = 4) -> DataFrame:
    """``docs`` without ``text`` but with ``ids`` and ``score`` of the best segmentation, the next
    ``n`` - 1 as ``others`` (fewer if there are no more), and ``round_trip``: whether decoding
    each of the segmentations gives back the text.

    A null or empty text has no ids and score 0. Equal scores: the best path takes the longer last
    piece, the others come in the order the search meets them. Rows are independent; other
    columns travel along, a column that has the name of a result is replaced.
    """
    names = [f.name for f in ENCODED]
    kept = [c for c in docs.columns if c not in (*names, "text")]
    schema = T.StructType([*docs.select(*kept).schema.fields, *ENCODED])

    def run(batches):
        v, encoder = vocabulary(path), Encoder(path, n)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            first = 0
            for found in encoder.encode(texts):
                size = len(found.length)
                cuts = np.concatenate(([0], np.cumsum(found.length)))
                same = [
                    decodes(v, texts[first + k], found.ids[cuts[k] : cuts[k + 1]], found.others[k])
                    for k in range(size)
                ]
                others = [
                    [{"score": x, "edits": [{"start": a, "length": m, "ids": p} for a, m, p in edits]} for x, edits in row]
                    for row in found.others
                ]
                data = [
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found.ids, pa.int32())),
                    pa.array(found.score), pa.array(others, _OTHERS), pa.array(same),
                ]
                columns = [c.slice(first, size) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, *data], [*kept, *names])
                first += size

    return docs.select(*kept, "text").mapInArrow(run, schema)


_OTHERS = pa.list_(pa.struct([
    ("score", pa.float64()),
    ("edits", pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))]))),
]))
