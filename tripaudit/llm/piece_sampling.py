"""Distinct sampled segmentations of texts into pieces: Gumbel top-k by perturbed A* search over the lattice.

A text is cut before each run of spaces; no piece crosses such a cut, so the
lattice of a text is the chain of its chunks' lattices, and those of distinct
chunks are built once. A segmentation is a walk from left to right whose
choices follow the lattice's conditional probabilities. The search holds
regions: all walks that share a beginning and avoid some next pieces. The
best perturbed value of a region is a Gumbel variable at its log-mass, below
the value of the walk that it was split from; the region with the highest
value is opened next, so that walks come out in falling order and never twice.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ALPHA = 0.5  # weight of a piece: -ALPHA * log(2 + its rank)
SAMPLES = 2
CACHE_EDGES = 8_000_000
BATCH_CHARS = 1_500_000
FAR = 40.0  # nats
SPACE = "▁"
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def uniforms(keys: np.ndarray, salt: int, positions: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) that depend on key, salt and position alone."""
    x = keys + (positions.astype(np.uint64) * np.uint64(64) + np.uint64(salt)) * _C1
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def gumbels(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def below(bound, location, u):
    """Gumbel variables at ``location``, given that they lie below ``bound``."""
    return -np.logaddexp(-bound, -(location + gumbels(u)))


class _Growing:
    """An array with room at its end."""

    def __init__(self, kind):
        self.room, self.size = np.zeros(1 << 12, kind), 0

    def extend(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.room):
            larger = np.zeros(max(need, 2 * len(self.room)), self.room.dtype)
            larger[: self.size] = self.room[: self.size]
            self.room = larger
        self.room[self.size : need] = values
        self.size = need

    @property
    def all(self) -> np.ndarray:
        return self.room[: self.size]


_BASE = np.uint64(0x100000001B3)
NODE_ARRAYS = {"first_edge": np.int64, "n_edges": np.int8}
EDGE_ARRAYS = {"siblings": np.int8, "edge_step": np.int8, "edge_id": np.int32, "edge_cum": np.float32, "edge_log": np.float64}
CHUNK_ARRAYS = {"chunk_node": np.int64, "chunk_size": np.int64}
PART_ARRAYS = {"part_first": np.int64, "part_chunks": np.int64, "chunks_of_part": np.int64}


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _in(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == values, at


def _falling_ranks(values: np.ndarray) -> np.ndarray:
    """0 for the largest values, 1 for the next, and so on; equal for equal ones."""
    order = np.argsort(-values)
    ranks = np.empty(len(values), np.int64)
    ranks[order] = np.cumsum(np.concatenate(([False], np.diff(values[order]) != 0)))
    return ranks


class Lattices:
    """Pieces and the lattices of the chunks seen so far, in flat arrays; emptied when they are full."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [b""] * n
        self.byte_ids = [0] * 256
        self.weights = np.zeros(n)
        self.byte_weight = -alpha * math.log(2 + n)
        by_length: dict[int, list] = {}
        prefixes: dict[int, set] = {}
        pairs = set()
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.pieces[i] = bytes([int(piece[3:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[i] = piece.replace(SPACE, " ").encode()
                self.weights[i] = -alpha * math.log(2 + min(n, max(0.0, -model.get_score(i))))
                codes = _codes(piece).tolist()
                h = 0
                for k, c in enumerate(codes):
                    h = (h * int(_BASE) + c + 1) & (2**64 - 1)
                    prefixes.setdefault(k + 1, set()).add(h)
                by_length.setdefault(len(codes), []).append((h, i))
                pairs.update(x << 32 | y for x, y in zip(codes, codes[1:]))
        self.prefixes = {k: np.array(sorted(v), np.uint64) for k, v in prefixes.items()}
        self.names = {k: np.full(len(v), -1, np.int64) for k, v in self.prefixes.items()}  # the piece that a prefix is, or -1
        for k, rows in by_length.items():
            rows = sorted(rows, reverse=True)  # of equal ones the first piece
            self.names[k][np.searchsorted(self.prefixes[k], np.array([h for h, _ in rows], np.uint64))] = [i for _, i in rows]
        self.pairs = np.array(sorted(pairs), np.uint64)
        self.spelled: list[np.ndarray] = []  # ids of a character's bytes, for edges with negative ids
        self.spelled_at: dict[int, int] = {}
        self.reset()

    def reset(self) -> None:
        self.parts: dict[bytes, int] = {}  # text between two spaces -> its number
        self.runs: dict[str, int] = {}  # the same for what starts otherwise than with one space
        self.chunks: dict[str, int] = {}
        self.store = {k: _Growing(t) for k, t in (NODE_ARRAYS | EDGE_ARRAYS | CHUNK_ARRAYS | PART_ARRAYS).items()}

    @property
    def full(self) -> bool:
        return self.store["edge_id"].size > CACHE_EDGES

    def _add(self, known: dict, names: list, parts: list[str]) -> None:
        """Number new parts, cut them where no piece holds both neighbours, and build the new chunks."""
        start = self.store["part_first"].size
        known.update(zip(names, range(start, start + len(names))))
        joined = "".join(parts)
        codes = _codes(joined)
        cut = np.zeros(len(codes) + 1, bool)
        cut[1:-1] = ~_in(self.pairs, codes[:-1] << np.uint64(32) | codes[1:])[0]
        ends = np.cumsum([len(p) for p in parts])
        cut[ends], cut[0] = True, True
        bounds = np.nonzero(cut)[0]
        firsts = np.searchsorted(bounds, np.concatenate([[0], ends]))
        texts = [joined[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        fresh = [t for t in dict.fromkeys(texts) if t not in self.chunks]
        if fresh:
            start = len(self.chunks)
            self.chunks.update(zip(fresh, range(start, start + len(fresh))))
            self._build(fresh)
        store = self.store
        first = store["chunks_of_part"].size
        store["chunks_of_part"].extend(np.fromiter(map(self.chunks.__getitem__, texts), np.int64, len(texts)))
        store["part_first"].extend(first + firsts[:-1])
        store["part_chunks"].extend(np.diff(firsts))

    def _spell(self, code: int) -> int:
        if code not in self.spelled_at:
            ids = [self.byte_ids[b] for b in chr(code).encode("utf-8", "surrogatepass")]
            self.spelled.append(np.array(ids, np.int32))
            self.spelled_at[code] = -len(self.spelled)
        return self.spelled_at[code]

    def _build(self, chunks: list[str]) -> None:
        """Lattices of chunks; edges carry their conditional log-probability, the likeliest first."""
        sizes = np.array([len(c) for c in chunks])
        codes = _codes("".join(chunks))
        end = np.repeat(np.cumsum(sizes), sizes)
        at, hashes = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        sources, steps, ids = [], [], []
        for k, prefix in self.prefixes.items():
            live = at + k <= end[at]
            at, hashes = at[live], hashes[live] * _BASE + codes[at[live] + k - 1] + np.uint64(1)
            live, place = _in(prefix, hashes)
            names = np.where(live, self.names[k][place], -1)
            hit = names >= 0
            sources.append(at[hit])
            steps.append(np.full(len(sources[-1]), k))
            ids.append(names[hit])
            if k == 1:
                missed = at[~hit]
                sources.append(missed)
                steps.append(np.ones(len(missed), np.int64))
                ids.append(np.array([self._spell(c) for c in codes[missed].tolist()], np.int64))
            at, hashes = at[live], hashes[live]
        source, step, piece = np.concatenate(sources), np.concatenate(steps), np.concatenate(ids)
        spelled = np.array([0, *(len(x) for x in self.spelled)])
        weight = np.where(piece >= 0, self.weights[np.maximum(piece, 0)], self.byte_weight * spelled[np.maximum(-piece, 0)])
        # Log-sums over all ways to the end, from the last characters of all chunks backwards.
        left = end - np.arange(len(codes))
        # Sorts are by one number a row, different for all rows: the same as lexsort, but by numpy's fast unstable sort.
        far = max(self.prefixes) + 1
        order = np.argsort((left[source] * len(codes) + source) * far + step)
        source, step, piece, weight = source[order], step[order], piece[order], weight[order]
        node_starts = np.nonzero(np.concatenate([[True], source[1:] != source[:-1]]))[0]
        at_left = left[source[node_starts]]
        rest = np.zeros(len(codes) + 1)
        value = np.empty(len(source))
        limits = np.searchsorted(at_left, np.arange(1, int(sizes.max()) + 2))
        for a, b in zip(limits[:-1].tolist(), limits[1:].tolist()):
            if a == b:
                continue
            low, high = node_starts[a], node_starts[b] if b < len(node_starts) else len(source)
            to = source[low:high] + step[low:high]
            own = weight[low:high] + np.where(to == end[source[low:high]], 0.0, rest[np.minimum(to, len(codes))])
            starts = node_starts[a:b] - low
            top = np.maximum.reduceat(own, starts)
            counts = np.diff(np.append(starts, high - low))
            total = np.add.reduceat(np.exp(own - np.repeat(top, counts)), starts)
            rest[source[node_starts[a:b]]] = top + np.log(total)
            value[low:high] = own - np.repeat(top + np.log(total), counts)
        order = np.argsort((source * len(value) + _falling_ranks(value)) * far + step)
        source, step, piece, value = source[order], step[order], piece[order], value[order]
        starts = np.searchsorted(source, np.arange(len(codes) + 1))
        p = np.exp(value)
        cum = np.cumsum(p)
        cum = cum - np.repeat(cum[starts[:-1]] - p[starts[:-1]], np.diff(starts))
        cum[starts[1:] - 1] = 2.0
        store, base = self.store, self.store["edge_id"].size
        # One more node per chunk, without edges, is its end.
        place = np.arange(len(codes)) + np.repeat(np.arange(len(chunks)), sizes)
        first_edge = np.zeros(len(codes) + len(chunks), np.int64)
        n_edges = np.zeros(len(first_edge), np.int8)
        first_edge[place], n_edges[place] = starts[:-1] + base, np.diff(starts)
        nodes = store["first_edge"].size
        store["chunk_node"].extend(nodes + np.cumsum(sizes + 1) - (sizes + 1))
        store["chunk_size"].extend(sizes)
        siblings = np.repeat(np.diff(starts), np.diff(starts))
        for name, values in (("first_edge", first_edge), ("n_edges", n_edges), ("siblings", siblings), ("edge_step", step), ("edge_id", piece), ("edge_cum", cum), ("edge_log", value)):
            store[name].extend(values)

    def chunks_of(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of the chunks of each text; the empty text has none."""
        plain, found = [], []
        for at, text in enumerate(texts):
            found.append(np.zeros(0, np.int64))
            if text and not (text[0] == " " or text[-1] == " " or "  " in text or SPACE in text):
                plain.append(at)
            elif text:
                parts = CHUNK.findall(SPACE + text.replace(" ", SPACE))
                own = [p for p in dict.fromkeys(parts) if p not in self.runs]
                if own:
                    self._add(self.runs, own, own)
                found[at] = np.fromiter(map(self.runs.__getitem__, parts), np.int64, len(parts))
        if plain:  # of these only the different parts become objects
            lists = pc.split_pattern(pa.array([texts[at].encode("utf-8", "surrogatepass") for at in plain], pa.binary()), b" ")
            coded = lists.flatten().dictionary_encode()
            parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            own = [p for p in parts if p not in self.parts]
            if own:
                self._add(self.parts, own, [SPACE + p.decode("utf-8", "surrogatepass") for p in own])
            numbers = np.fromiter(map(self.parts.__getitem__, parts), np.int64, len(parts))[coded.indices.to_numpy()]
            for at, some in zip(plain, np.split(numbers, np.cumsum(pc.list_value_length(lists).to_numpy())[:-1])):
                found[at] = some
        store = self.store
        every = np.concatenate(found) if found else np.zeros(0, np.int64)
        counts = store["part_chunks"].all[every]
        ends = np.cumsum(counts)
        chunks = store["chunks_of_part"].all[np.repeat(store["part_first"].all[every] - (ends - counts), counts) + np.arange(int(counts.sum()))]
        bounds = np.concatenate([[0], ends])[np.cumsum([0, *map(len, found)])]
        return [chunks[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: v.all for k, v in self.store.items()}

    def expand(self, ids: np.ndarray) -> np.ndarray:
        """Piece ids with each spelled character replaced by its bytes' ids."""
        if not (ids < 0).any():
            return ids
        parts, last = [], 0
        for at in np.nonzero(ids < 0)[0].tolist():
            parts += [ids[last:at], self.spelled[-int(ids[at]) - 1]]
            last = at + 1
        return np.concatenate([*parts, ids[last:]])


def walk(a: dict, nodes: np.ndarray, keys: np.ndarray, positions: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Sample every chunk from its given node to its end: edges in order, and how many each chunk has."""
    counts = np.zeros(len(nodes), np.int64)
    active, node, offset = np.arange(len(nodes)), nodes.copy(), np.zeros(len(nodes), np.int64)
    steps = []
    live = a["n_edges"][node] > 0
    active, node, offset = active[live], node[live], offset[live]
    while len(active):
        u = uniforms(keys[active], salt, positions[active] + offset)
        edge = a["first_edge"][node]
        open_ = np.nonzero(u >= a["edge_cum"][edge])[0]
        while len(open_):
            edge[open_] += 1
            open_ = open_[u[open_] >= a["edge_cum"][edge[open_]]]
        steps.append((active, edge))
        counts[active] += 1
        gone = a["edge_step"][edge].astype(np.int64)
        node, offset = node + gone, offset + gone
        live = a["n_edges"][node] > 0
        active, node, offset = active[live], node[live], offset[live]
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int64)
    for k, (own, edge) in enumerate(steps):
        out[starts[own] + k] = edge
    return out, counts


class _Text:
    """One text under search: its chunks, the walks found, and the best regions left."""

    __slots__ = ("key", "nodes", "positions", "regions", "walks")

    def __init__(self, key, nodes, positions):
        self.key, self.nodes, self.positions = key, nodes, positions
        self.regions: list[tuple] = []
        self.walks: list[tuple] = []


def _masses(a: dict, logs: np.ndarray, siblings: np.ndarray, from_step: int, barred: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Steps at which a walk can be left, from ``from_step`` on, and the log-mass that leaves it there."""
    before = np.cumsum(logs) - logs
    p = np.exp(logs[from_step:])
    if barred:
        p[0] += math.fsum(math.exp(a["edge_log"][e]) for e in barred)
    # What is left of a node's mass; where it is lost in rounding, a trace.
    mass = before[from_step:] + np.log(np.maximum(1 - p, 1e-17))
    others = siblings[from_step:] - 1
    if barred:
        others[0] -= len(barred)
    at = np.nonzero(others > 0)[0]
    return at + from_step, mass[at]


def _push(text: _Text, edges: np.ndarray, steps: np.ndarray, values: np.ndarray, from_step: int, barred: tuple, walk_number: int, want: int) -> None:
    best = np.argpartition(-values, want - 1)[:want] if len(values) > want else np.arange(len(values))
    for i in best.tolist():
        step = int(steps[i])
        own = (*(barred if step == from_step else ()), int(edges[step]))
        heapq.heappush(text.regions, (-float(values[i]), walk_number, step, own))


def _split(a: dict, text: _Text, from_step: int, barred: tuple, value: float, salt: int, want: int) -> None:
    """Add the best regions around the walk found last: those that leave it at ``from_step`` or later.

    All that leaves it after its probability has fallen by ``FAR`` is one
    region, taken apart only if it is ever opened.
    """
    number = len(text.walks) - 1
    edges, logs, siblings, _ = text.walks[number]
    before = np.cumsum(logs) - logs
    near = max(from_step + 1, int(np.searchsorted(-before, FAR - float(before[from_step]), side="right")))
    steps, mass = _masses(a, logs[:near], siblings[:near], from_step, barred)
    values = below(value, mass, uniforms(np.full(len(steps), text.key, np.uint64), salt, steps))
    _push(text, edges, steps, values, from_step, barred, number, want)
    if near < len(edges) and (siblings[near:] > 1).any():
        rest = float(before[near]) + math.log(-math.expm1(min(-1e-17, float(logs[near:].sum()))))
        u = uniforms(np.array([text.key], np.uint64), salt, np.array([near + (1 << 41)]))
        heapq.heappush(text.regions, (-float(below(value, rest, u)[0]), number, near, ()))
    if len(text.regions) > want:
        text.regions = heapq.nsmallest(want, text.regions)


def _open_far(a: dict, text: _Text, value: float, number: int, near: int, salt: int, want: int) -> tuple[int, tuple] | None:
    """Step and barred edges of the region that holds the best walk of a far region; its other parts go back."""
    edges, logs, siblings, _ = text.walks[number]
    steps, mass = _masses(a, logs, siblings, near, ())
    if not len(steps):
        return None
    keys = np.full(len(steps), text.key, np.uint64)
    first = int(np.argmax(mass + gumbels(uniforms(keys, salt, steps + (1 << 42)))))
    others = np.arange(len(steps)) != first
    values = below(value, mass[others], uniforms(keys[others], salt, steps[others] + (1 << 43)))
    _push(text, edges, steps[others], values, near, (), number, want)
    return int(steps[first]), (int(edges[steps[first]]),)


def _first_of(a: dict, edge: int) -> int:
    """First edge of the node that an edge leaves."""
    while edge > 0 and a["edge_cum"][edge - 1] < 2.0:
        edge -= 1
    return edge


def _alternative(a: dict, barred: tuple, u: float) -> int:
    """Another edge of the barred edges' node, by its renewed probability."""
    edge, choices = _first_of(a, barred[0]), []
    while True:
        if edge not in barred:
            choices.append((edge, math.exp(a["edge_log"][edge])))
        if a["edge_cum"][edge] >= 2.0:
            break
        edge += 1
    u *= math.fsum(p for _, p in choices)
    for edge, p in choices:
        u -= p
        if u < 0:
            break
    return edge


def sample_texts(lattices: Lattices, keys: list[int], texts: list[str], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """Per text up to ``k`` distinct segmentations ``(ids, log_prob, perturbed, log_inclusion)``, best value first.

    ``log_inclusion`` is the log-probability that a Gumbel variable at the
    segmentation's log-probability exceeds the next best perturbed value; it
    is 0 where all segmentations were found.
    """
    numbers = lattices.chunks_of(texts)
    a = lattices.arrays()
    found: list[_Text] = []
    for key, own in zip(keys, numbers):
        sizes = a["chunk_size"][own]
        found.append(_Text(key, a["chunk_node"][own], np.cumsum(sizes) - sizes))
    for rank in range(k):
        jobs = []  # text, value, shared edges, alternative, chunk to go on from, node and position there
        for t in found:
            if rank == 0:
                first = float(gumbels(uniforms(np.array([t.key], np.uint64), 63, np.zeros(1)))[0])
                jobs.append((t, first, np.zeros(0, np.int64), (), 0, None, 0))
                continue
            if not t.regions:
                continue
            value, parent, step, barred = heapq.heappop(t.regions)
            if not barred:
                opened = _open_far(a, t, -value, parent, step, 2 * rank, k - rank + 1)
                if opened is None:
                    continue
                step, barred = opened
            edges = t.walks[parent][0]
            u = float(uniforms(np.array([t.key], np.uint64), 2 * rank, np.array([step + (1 << 40)]))[0])
            edge = _alternative(a, barred, u)
            position = int(a["edge_step"][edges[:step]].sum(dtype=np.int64))
            chunk = int(np.searchsorted(t.positions, position, side="right")) - 1
            inside = position - int(t.positions[chunk]) + int(a["edge_step"][edge])
            shared = np.append(edges[:step], edge)
            jobs.append((t, -value, shared, barred, chunk, int(t.nodes[chunk]) + inside, inside))
        if not jobs:
            break
        nodes, positions, owners = [], [], []
        for t, _, _, _, chunk, node, inside in jobs:
            own, where = t.nodes[chunk:].copy(), t.positions[chunk:].copy()
            if node is not None and len(own):
                own[0], where[0] = node, where[0] + inside
            nodes.append(own)
            positions.append(where)
            owners.append(np.full(len(own), t.key, np.uint64))
        edges, counts = walk(a, np.concatenate(nodes), np.concatenate(owners), np.concatenate(positions), 2 * rank)
        logs, siblings = a["edge_log"][edges], a["siblings"][edges]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *map(len, nodes)])].tolist()
        for (t, value, shared, barred, _, _, _), low, high in zip(jobs, ends, ends[1:]):
            own = edges[low:high], logs[low:high], siblings[low:high]
            if len(shared):
                own = tuple(np.concatenate([x, y]) for x, y in zip((shared, a["edge_log"][shared], a["siblings"][shared]), own))
            t.walks.append((*own, value))
            if len(own[0]):
                _split(a, t, max(0, len(shared) - 1), barred, value, 2 * rank + 1, k - rank)
    out = []
    for t in found:
        limit = -t.regions[0][0] if t.regions else None
        rows = []
        for edges, logs, _, value in t.walks:
            log_prob = float(logs.sum())
            inclusion = 0.0 if limit is None else _log_inclusion(log_prob - limit)
            rows.append((lattices.expand(a["edge_id"][edges]), log_prob, value, inclusion))
        out.append(rows)
    return out


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x)))"""
    if x < -30:
        return x
    return math.log(-math.expm1(-math.exp(min(x, 700)))) if x < 30 else 0.0


@lru_cache(maxsize=2)
def lattices_of(path: str, alpha: float) -> Lattices:
    return Lattices(path, alpha)


class Decoder:
    """Texts of piece ids: the space put before the first word goes, bytes become characters."""

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.array([len(p) for p in pieces])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def __call__(self, ids: np.ndarray) -> str:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        raw = self.flat[at + np.arange(len(at))].tobytes()
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def sample(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES, alpha: float = ALPHA
) -> DataFrame:
    """Rows ``id, rank, ids, log_prob, perturbed, log_inclusion, decoded``: up to ``k`` segmentations per text.

    ``ids`` are little-endian 32-bit numbers, ``decoded`` is the text that they give back. Draws are seeded by the
    row's id alone, so equal rows and runs again after a lost task give equal samples. A
    null or empty text has one segmentation, the empty one; a text with fewer
    than ``k`` segmentations gives all it has; an empty table gives an empty
    result; other columns are not looked at. No shuffle; a task holds one
    batch of about ``BATCH_CHARS`` characters, or one longer text.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField("rank", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
            *(T.StructField(n, T.DoubleType()) for n in ("log_prob", "perturbed", "log_inclusion")),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = lattices_of(model, alpha)
        decode = Decoder(lattices.pieces)

        def emit(names, keys, texts):
            if lattices.full:
                lattices.reset()
            rows = [(name, rank, *row) for name, own in zip(names, sample_texts(lattices, keys, texts, k)) for rank, row in enumerate(own)]
            ids = pa.array([r[2].astype("<i4").tobytes() for r in rows], pa.binary())
            doubles = [pa.array([r[i] for r in rows], pa.float64()) for i in (3, 4, 5)]
            decoded = pa.array([decode(r[2]) for r in rows], pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int32()), ids, *doubles, decoded],
                names=[f.name for f in schema],
            )

        for batch in batches:
            kind = batch.column(0).type
            held: tuple[list, list, list] = ([], [], [])
            size = 0
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[0].append(name)
                held[1].append(xxhash.xxh64_intdigest(repr(name)))
                held[2].append(text or "")
                size += len(text or "")
                if size >= BATCH_CHARS:
                    yield emit(*held)
                    held, size = ([], [], []), 0
            if held[0]:
                yield emit(*held)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
